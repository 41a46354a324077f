"""Queries of the training-data operators and the SQL that some of them can be checked against."""

from __future__ import annotations

from collections.abc import Callable

from .decontamination import op1_decontamination
from .language_id import op7_language_id
from .line_dedup import OP3_SQL, op3_line_dedup
from .near_dedup import OP2_SQL, op2_near_dedup
from .packing import op5_packing
from .quality_classifier import op6_quality_classifier
from .quality_rules import op9_quality_rules
from .sharding import op8_sharding
from .substring_dedup import OP4_SQL, op4_substring_dedup
from .warc import OP10_SQL, op10_warc

QUERIES: dict[str, Callable] = {
    "op1_decontamination": op1_decontamination,
    "op2_near_dedup": op2_near_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_language_id": op7_language_id,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
}
ORACLES: dict[str, str] = {
    "op2_near_dedup": OP2_SQL, "op3_line_dedup": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op10_warc": OP10_SQL,
}

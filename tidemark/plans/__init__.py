"""Named plans over the test tables."""

from tidemark.plans import corpus, more, retrieval  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401

"""Quality rules: exact counts of a text, then a hashed n-gram log-likelihood ratio with a fixed threshold.

For single tokens and for pairs, two multinomials over hash buckets are compared: the raw corpus (every document) and a
trusted target (labelled documents). A document's score of an order is the sum of the log ratios of its n-grams over
the square root of their number, the scale on which sums of texts of all lengths spread alike. Every trusted document is
used: one half of them (by a hash of the id) makes the target counts, the other half, which did not enter these, sets the
thresholds once. These then hold for every document alike; both must be met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only

BITS = 18
ORDERS = (1, 2)
SMOOTHING = 3.0
#: Share of held-out trusted texts (each distinct score once) that may fall below the threshold of an order.
LOST_TRUSTED = 0.005
#: So many ids of trusted rows, about, are broadcast at once; documents are read once per block, until all are found.
TRUSTED_BLOCK = 500_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LINE_CLASS = np.ones(256, np.uint8)
_LINE_CLASS[10] = 0
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def base_counts(part: K.Slice) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text of a slice."""
    w = K.words(part)
    in_word = K.WORD_CLASS[part.data] > 0
    lines = K.words(part, _LINE_CLASS)
    filled = np.concatenate([[0], np.cumsum(in_word)])
    has_word = filled[lines.end] > filled[lines.start]
    before, _ = K.seen_before(lines.text[has_word], lines.hash[has_word])
    hashes, at = K.grams(w, 5)
    _, shared = K.seen_before(w.text[at], hashes)
    repeat = K.cover(at[shared], 5, len(w.hash))
    n = len(part)
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": _per_text(in_word & _FIRST_BYTE[part.data], part.offsets),
        "n_symbols": _per_text(_SYMBOL[part.data], part.offsets),
        "n_dup_lines": np.bincount(lines.text[has_word][before], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(w.text[repeat], minlength=n).astype(np.int64),
    }


def features(part: K.Slice, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hash buckets of all token n-grams of a slice; every order has buckets of its own."""
    w = K.words(part, K.TOKEN_CLASS, lower=True)
    text, bucket = [], []
    for k, n in enumerate(orders):
        hashes, at = (w.hash, np.arange(len(w.hash))) if n == 1 else K.grams(w, n)
        text.append(w.text[at])
        bucket.append((hashes >> np.uint64(64 - bits)).astype(np.int64) + (k << bits))
    return np.concatenate(text), np.concatenate(bucket)


def _counter(bits: int, orders: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(orders) << bits
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in K.slices(batch.column(0)):
                total += np.bincount(features(part, bits, orders)[1], minlength=size)
        used = np.flatnonzero(total)
        for at in range(0, len(used), 50_000):
            b = used[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(total[b])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, bits: int, orders: tuple[int, ...]) -> np.ndarray:
    """How often each bucket occurs in a table of texts; a row per order."""
    counted = texts.mapInArrow(_counter(bits, orders), "bucket long, n long")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(orders) << bits)
    out[table["bucket"]] = table["n"]
    return out.reshape(len(orders), -1)


def log_ratios(raw: np.ndarray, target: np.ndarray, smoothing: float) -> np.ndarray:
    """log of observed over expected target counts, drawn towards 0 where counts are small."""
    expected = raw * (target.sum() / max(1.0, raw.sum()))
    return np.log((target + smoothing) / (expected + smoothing)).astype(np.float32)


def scores(part: K.Slice, weights: np.ndarray, bits: int, orders: tuple[int, ...]) -> np.ndarray:
    """Length-normalised score of every text (rows) and order (columns); 0 for a text without n-grams of the order."""
    text, bucket = features(part, bits, orders)
    n = len(part)
    key = text * len(orders) + (bucket >> bits)
    count = np.bincount(key, minlength=n * len(orders))
    return (np.bincount(key, weights[bucket], n * len(orders)) / np.sqrt(np.maximum(1, count))).reshape(n, -1)


def _scorer(weights, bits, orders):
    def run(batches):
        for batch in batches:
            out = [scores(p, weights.value, bits, orders) for p in K.slices(batch.column(0))]
            rows = np.concatenate(out) if out else np.zeros((0, len(orders)))
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.list_(pa.float64()))], ["scores"])

    return run


def _judge(weights, threshold, bits, orders, most_repeat, least_words):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for batch in batches:
            parts = [base_counts(p) | {"margin": (scores(p, weights.value, bits, orders) - threshold).min(axis=1)} for p in K.slices(batch.column(1))]
            if not parts:
                continue
            cols = {k: np.concatenate([p[k] for p in parts]) for k in [*names, "margin"]}
            failed = (cols["n_words"] < least_words) | (100 * cols["n_repeat_words"] > most_repeat * cols["n_words"])
            kept = ~failed & (cols["margin"] >= 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(cols[k]) for k in names], pa.array(failed), pa.array(kept), pa.array(cols["margin"])],
                ["_id", *names, "base_failed", "kept", "margin"],
            )

    return run


def _trusted_rows(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, block: int, ws: Workspace) -> list[DataFrame]:
    """_text and _held of all documents with a trusted id, as saved tables: one for each block of ids."""
    ids = ws.save(trusted.filter(trusted[id_col].isNotNull()).select(id_col).distinct(), "trusted")
    blocks = max(1, math.ceil(ids.count() / block))
    held = F.pmod(F.shiftright(F.xxhash64(id_col), 20), F.lit(2)) == 0
    out = []
    for b in range(blocks):
        some = ids.filter(F.pmod(F.xxhash64(F.lit("block"), id_col), F.lit(blocks)) == b)
        found = docs.join(F.broadcast(some), id_col, "left_semi")
        out.append(ws.save(found.select(F.col(text_col).alias("_text"), held.alias("_held")), "found"))
    ws.drop(ids)
    return out


def lower_quantile(values: DataFrame, column: str, share: float) -> float | None:
    """The value of rank ceil(share * rows), at least 1, from below: exact. None for an empty table."""
    rank = max(1, math.ceil(share * values.count()))
    return values.select(column).orderBy(column).limit(rank).agg(F.max(column)).first()[0]


def judge(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
    orders: tuple[int, ...] = ORDERS, smoothing: float = SMOOTHING, lost_trusted: float = LOST_TRUSTED,
    trusted_block: int = TRUSTED_BLOCK, most_repeat: int = 20, least_words: int = 10,
) -> DataFrame:
    """A row per document: id, the five counts, base_failed, kept, and margin (of the scores over their thresholds).

    trusted: a table with id_col; all of its rows are used, trusted_block ids at a time, which changes no result.
    Null or empty text: all counts 0, fails.
    Rows with a null id are counted and judged like others but are never trusted; repeated rows are judged one by one.
    Without trusted documents all ratios are 0 and the base rules alone decide. Other columns are left out.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "rules")
    docs = only(docs, id_col, text_col)
    raw = bucket_counts(docs.select(text_col), bits, orders)
    saved = _trusted_rows(docs, trusted, id_col, text_col, trusted_block, ws)
    rows = reduce(DataFrame.unionByName, saved)
    target = bucket_counts(rows.filter(~F.col("_held")).select("_text"), bits, orders)
    weights = spark.sparkContext.broadcast(np.concatenate([log_ratios(r, t, smoothing) for r, t in zip(raw, target)]))
    held = rows.filter("_held").select("_text").mapInArrow(_scorer(weights, bits, orders), "scores array<double>")
    # each distinct score once, so that a text with many copies doesn't set the threshold
    parts = held.select(F.posexplode("scores").alias("k", "s")).select("k", F.round("s", 9).alias("s")).distinct()
    parts = ws.save(parts, "scores")
    found = [lower_quantile(parts.filter(F.col("k") == k), "s", lost_trusted) for k in range(len(orders))]
    threshold = np.array([-np.inf if t is None else t for t in found])
    ws.drop(parts, *saved)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, margin double"
    return docs.mapInArrow(_judge(weights, threshold, bits, orders, most_repeat, least_words), schema).withColumnRenamed("_id", id_col)


def good(labels: DataFrame) -> Column:
    return (labels["quality"] == 1) & (labels["toxic"] == 0)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: all documents, with those labelled good and not toxic as the trusted target."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.filter(good(labels)).select("doc_id"))

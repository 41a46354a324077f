"""Removal of long passages that repeat, found by recompression.

A text is a sequence of word symbols. Every round first names runs of one symbol, then pairs: a hash bit deals the
alphabet into left and right symbols, and each left symbol followed by a right one becomes a symbol of its own. Names are
hashes of what they stand for, so all tasks give equal parts equal names without a dictionary. Each phase can change
one symbol at either end of two equal passages; so after the rounds the symbols over a window's interior are the same
wherever the window occurs. The longest of them (ties by name) is the window's anchor. Windows whose anchor occurs
once occur once. The others, and those with a run at an end (where the bound doesn't hold), are verified by 96-bit
fingerprints of their words, over the whole corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only, with_row_key

WINDOW = 35


def rounds_for(window: int) -> tuple[int, int]:
    """Rounds whose erosion leaves at least half of a window as interior, and words eroded at each end."""
    rounds = 0
    while 4 * (2 ** (rounds + 1) - 1) <= window / 2:
        rounds += 1
    return rounds, 2 * (2**rounds - 1)


#: Words that short runs may add to the erosion at an end, and the length from which a run is long.
SLACK, LONG = 2, 4


def slack_for(window: int) -> int:
    """SLACK, where a quarter of the window still remains as interior; else none."""
    return SLACK if window - 2 * (rounds_for(window)[1] + SLACK) >= window / 4 else 0


def recompress(w: K.Words, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after the rounds, the first word of each, and the words of runs and of long runs."""
    name, first, text = w.hash, np.arange(len(w.hash)), w.text
    n = len(name)
    in_run, in_long = np.zeros(n, bool), np.zeros(n, bool)
    for r in range(rounds):
        # runs
        if len(name) > 1:
            same = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
            if same.any():
                heads = np.flatnonzero(np.r_[True, ~same])
                lengths = np.diff(np.r_[heads, len(name)])
                ends = np.r_[first[heads[1:]], n]
                for a, b in zip(first[heads][lengths > 1], ends[lengths > 1]):
                    in_run[a:b] = True
                    in_long[a:b] |= b - a >= LONG
                with np.errstate(over="ignore"):
                    run = K.mix(name[heads] + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                name = np.where(lengths > 1, run, name[heads])
                first, text = first[heads], text[heads]
        # pairs
        if len(name) > 1:
            with np.errstate(over="ignore"):
                right = (K.mix(name + np.uint64(2 * r + 1)) & np.uint64(1)).astype(bool)
                joined = ~right[:-1] & right[1:] & (text[1:] == text[:-1])
                pair = K.mix(name[:-1] * np.uint64(0xD6E8FEB86659FD93) + name[1:] + np.uint64(r))
            name = np.where(np.r_[joined, False], np.r_[pair, np.uint64(0)], name)
            stays = np.r_[True, ~joined]
            name, first, text = name[stays], first[stays], text[stays]
    return name, first, in_run, in_long


def anchors(w: K.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of a slice: first word, anchor, the anchor's first word, and whether a run lies at an end.

    A run inside is the same wherever the window occurs. One among the eroded words at an end may be longer outside, and
    takes more words with it than the bound allows for one symbol: one more for a pair of words, two for three. That
    much is added to the eroded words where the window has room for it; ends with more or longer runs are told apart.
    """
    rounds, eroded = rounds_for(window)
    slack = slack_for(window)
    eroded += slack
    n = len(w.hash)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none.astype(np.uint64), none, none.astype(bool)
    starts = np.flatnonzero(w.text[: n - window + 1] == w.text[window - 1 :])
    name, first, in_run, in_long = recompress(w, rounds)
    lengths = np.diff(np.r_[first, n])
    key = (np.minimum(lengths, 255).astype(np.uint64) << np.uint64(56)) | (name >> np.uint64(8))
    by_word = np.repeat(key, lengths)
    inner = window - 2 * eroded
    best = K.sliding_max(by_word, inner)[starts + eroded]
    runs, long_runs = (np.concatenate([[0], np.cumsum(x)]) for x in (in_run, in_long))
    # the place of an anchor: the first symbol of that name at or after the interior's beginning
    symbol = np.repeat(np.arange(len(name)), lengths)
    place = _first_at(key, symbol[starts + eroded], best)
    last = starts + window
    at_end = np.zeros(len(starts), bool)
    for lo, hi in ((starts, starts + eroded), (last - eroded, last)):
        at_end |= (runs[hi] - runs[lo] > slack + 1 if slack else runs[hi] > runs[lo]) | (long_runs[hi] > long_runs[lo])
    return starts, best, first[place], at_end


def _first_at(key: np.ndarray, low: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each query the first index >= low whose key is the wanted one (there is one)."""
    order = np.lexsort((np.arange(len(key)), key))
    ranked = key[order]
    left = np.searchsorted(ranked, wanted, "left")
    right = np.searchsorted(ranked, wanted, "right")
    out = order[left]
    late = np.flatnonzero((out < low) & (right - left > 1))
    if len(late):
        # binary search inside the group of equal keys, where indices ascend
        a, b = left[late].copy(), right[late] - 1
        while (a < b).any():
            m = (a + b) // 2
            go = order[m] < low[late]
            a, b = np.where((a < b) & go, m + 1, a), np.where((a < b) & ~go, m, b)
        out[late] = order[a]
    return out


def _emit_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in K.slices(batch.column(1)):
                w = K.words(part)
                starts, key, place, _ = anchors(w, window)
                if not len(starts):
                    continue
                change = np.r_[True, (place[1:] != place[:-1])]
                key, place = key[change], place[change]
                place, at = np.unique(place, return_index=True)
                key, text = key[at], w.text[place]
                order = np.lexsort((key, text))
                key, text = key[order], text[order]
                heads = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
                count = np.minimum(np.diff(np.r_[heads, len(key)]), 2)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text[heads] + part.first)), pa.array(K.signed(key[heads])), pa.array(count.astype(np.int8))],
                    ["_row", "anchor", "n"],
                )

    return run


_WINDOWS = "_row long, start int, f1 long, f2 int, weight int"
#: What is known of exact copies: the one that gives the windows of its class, and the others.
FIRST, OTHER = 1, 2


def _candidates(window: int):
    """Candidate windows of every text (_row, text, shared anchors, copy) but copies other than the first."""

    def run(batches):
        for batch in batches:
            ids, texts, shared, copies = (batch.column(k) for k in range(4))
            copy = copies.fill_null(0).to_numpy(zero_copy_only=False)
            for part in K.slices(texts):
                w = K.words(part)
                n = len(part)
                own = slice(part.first, part.first + n)
                lists = shared.slice(part.first, n)
                owner = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                names = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                starts, key, _, at_end = anchors(w, window)
                text = w.text[starts]
                with np.errstate(over="ignore"):
                    tag = lambda t, k: K.mix(k + K.mix(t.astype(np.uint64)))
                    hit = np.isin(tag(text, key), tag(owner, names))
                use = (hit | at_end) & (copy[own] != OTHER)[text]
                f1, f2 = K.windows(w, window, 0)[0][use], K.windows(w, window, 1)[0][use]
                text, first = text[use], (starts - w.first[text])[use]
                weight = np.where(copy[own][text] == FIRST, 2, 1)
                row_ids = ids.slice(part.first, n)
                for lo in range(0, len(text), 50_000):
                    cut = slice(lo, lo + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            row_ids.take(pa.array(text[cut])), pa.array(first[cut].astype(np.int32)), pa.array(K.signed(f1[cut])),
                            pa.array((f2[cut] >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(weight[cut].astype(np.int32)),
                        ],
                        ["_row", "start", "f1", "f2", "weight"],
                    )

    return run


def _finish(window: int):
    """Rows (_row, text, starts, copy) with what is left of them."""

    def run(batches):
        for batch in batches:
            ids, texts, starts = batch.column(0), batch.column(1), batch.column(2)
            copy = batch.column(3).fill_null(0).to_numpy(zero_copy_only=False)
            for part in K.slices(texts):
                w = K.words(part)
                removed, kept = [], []
                raw = part.data.tobytes()
                for k in range(len(part)):
                    n, f = int(w.counts[k]), int(w.first[k])
                    if copy[part.first + k]:
                        gone = np.full(n, n >= window)
                    else:
                        gone = K.cover(np.asarray(starts[part.first + k].as_py() or [], np.int64), window, n)
                    stays = np.flatnonzero(~gone) + f
                    kept.append(b" ".join([raw[a:b] for a, b in zip(w.start[stays].tolist(), w.end[stays].tolist())]).decode())
                    removed.append(int(gone.sum()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.first, len(part)), pa.array(w.counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["_row", "n_words", "n_removed", "kept_text"],
                )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """A row per input row: id, n_words, n_removed and kept_text (kept words joined by one space).

    Removes each word in a window of so many words that also starts anywhere else, in the same row or another; windows
    are judged on the input. Null, empty and short texts lose nothing. Repeated rows are texts of their own, so all
    their windows repeat. Null ids are rows like others. Other columns are left out. An empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "repeats")
    keyed = with_row_key(only(docs, id_col, text_col).withColumnRenamed(text_col, "_text"), id_col, ws)
    # exact copies lose everything that is long enough; the first of a class gives its windows, for all of them
    hashed = keyed.select("_row", F.md5("_text").alias("_md5"))
    classes = hashed.filter(F.col("_md5").isNotNull()).groupBy("_md5").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    copies = hashed.join(ws.save(classes.filter("_n > 1"), "classes"), "_md5")
    copies = ws.save(copies.select("_row", F.when(F.col("_row") == F.col("_first"), FIRST).otherwise(OTHER).alias("_copy")), "copies")
    found = keyed.select("_row", "_text").mapInArrow(_emit_anchors(window), "_row long, anchor long, n byte")
    found = ws.save(found.join(copies.filter(F.col("_copy") == OTHER), "_row", "left_anti"), "anchors")
    shared = ws.save(found.groupBy("anchor").agg(F.sum("n").alias("_n")).filter("_n > 1").select("anchor"), "shared")
    lists = found.join(shared, "anchor").select("_row", "anchor").groupBy("_row").agg(F.collect_list("anchor").alias("_shared"))
    known = ws.save(lists.join(copies, "_row", "full"), "known")
    ws.drop(found, shared)
    ws.collect_garbage()
    rows = keyed.join(known, "_row", "left").select("_row", "_text", "_shared", "_copy").mapInArrow(_candidates(window), _WINDOWS)
    rows = ws.save(rows, "windows")
    ws.drop(known)
    ws.collect_garbage()
    twice = ws.save(rows.groupBy("f1", "f2").agg(F.sum("weight").alias("_n")).filter("_n > 1").select("f1", "f2"), "twice")
    ws.collect_garbage()
    starts = rows.select("_row", "start", "f1", "f2").join(twice, ["f1", "f2"]).groupBy("_row").agg(F.collect_list("start").alias("_starts"))
    starts = ws.save(starts.join(copies, "_row", "full"), "starts")
    ws.drop(rows, twice)
    ws.collect_garbage()
    schema = "_row long, n_words long, n_removed long, kept_text string"
    out = keyed.select("_row", "_text").join(starts, "_row", "left").select("_row", "_text", "_starts", "_copy").mapInArrow(_finish(window), schema)
    if not hasattr(keyed, "_workspace_path"):
        return out.select(F.col("_row").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "n_removed", "kept_text")
    return keyed.select("_row", id_col).join(out, "_row").drop("_row")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: passages of 35 words that repeat, removed from all documents."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), twice AS (SELECT h FROM starts GROUP BY 1 HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM starts SEMI JOIN twice USING (h)),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM every ANTI JOIN gone USING (doc_id, k) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def remove_repeats_by_hand(texts: list[str | None], window: int = WINDOW) -> list[tuple[int, int, str]]:
    """The same for a few texts, by counting all windows: n_words, n_removed and the digest of what stays."""
    import re
    from collections import Counter

    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {k for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for k in range(i, i + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out

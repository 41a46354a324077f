"""Quality classification by co-training of a text view and a metadata view.

Two logistic models over log-odds weighted features see different things: the tokens of a text, and what describes the
page (source, language, length, layout). Both are fitted on a bounded sample of labelled rows. Over some rounds every
document is judged by both views, and those that one is sure of count as examples of the other: their features enter the
other's class counts, summed up by Spark over the whole table, and tell the log odds of features that few or no labelled
rows hold.
Each view is calibrated on labelled rows that took no part in the fit, the calibrated log-odds are combined, and every
document of the table is scored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .workspace import Workspace, only

BITS = 16
META_BITS = 10
#: Labelled rows used at most (those with the smallest hashes of their ids).
MOST_LABELLED = 10_000
#: Features of labelled rows that the driver holds at most, about 12 bytes each: with very long texts fewer rows are used.
MOST_FEATURES = 6_000_000
#: Rounds in which the views exchange what they are sure of; each is a pass over all documents.
ROUNDS = 2
#: A view gives the other all documents that it judges with this confidence at least; together they weigh this share of
#: the labelled ones of their class.
CONFIDENT, SHARE = 0.95, 0.3
ACCEPT = 0.4
_STEPS = 200


_REPEATS = K.stream(31, 11)


def text_features(part: K.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct tokens of every text (words in lower case, and marks) and of the share of words
    that repeat the one before, in tenths."""
    w = K.words(part, K.TOKEN_CLASS, lower=True)
    again = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    share = 10 * np.bincount(w.text[1:][again], minlength=len(part)) // np.maximum(1, w.counts)
    text = np.r_[w.text, np.arange(len(part))]
    bucket = np.r_[(w.hash >> np.uint64(64 - BITS)).astype(np.int64), (_REPEATS[np.minimum(share, 10)] >> np.uint64(64 - BITS)).astype(np.int64)]
    pair = np.unique((text.astype(np.int64) << BITS) | bucket)
    return pair >> BITS, pair & ((1 << BITS) - 1)


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def meta_features(part: K.Slice, source: list, lang: list) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of what describes the page: source, language, and binned length and layout."""
    w = K.words(part, K.TOKEN_CLASS)
    n = len(part)

    def total(flags):
        t = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return t[part.offsets[1:]] - t[part.offsets[:-1]]

    size = np.maximum(1, np.diff(part.offsets))
    lines = total(part.data == 10) + 1
    bins = {
        "size": np.log2(size).astype(int),
        "line": np.log2(size / lines).astype(int),
        "upper": np.minimum(20, 100 * total(_UPPER[part.data]) // size // 4),
        "marks": np.minimum(20, 200 * total(K.TOKEN_CLASS[part.data] == 2) // size // 4),
        "tokens": np.minimum(15, size // np.maximum(1, w.counts)),
    }
    names = [[f"source={s}", f"lang={g}", *[f"{k}={bins[k][i]}" for k in bins]] for i, (s, g) in enumerate(zip(source, lang))]
    rows = np.repeat(np.arange(n), [len(x) for x in names])
    return rows, np.array([zlib.crc32(f.encode()) % (1 << META_BITS) for x in names for f in x], np.int64)


class Rows:
    """Sparse binary rows scaled to unit length, in narrow types: the sample is what the driver holds."""

    def __init__(self, lists, size: int):
        lengths = np.array([len(x) for x in lists], np.int64)
        self.n, self.size = len(lists), size
        self.at = np.concatenate([np.zeros(0, np.int32), *[np.asarray(x, np.int32) for x in lists]])
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), lengths)
        self.value = np.repeat((1 / np.sqrt(np.maximum(1, lengths))).astype(np.float32), lengths)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights.astype(np.float32)[self.at] * self.value, self.n) + weights[-1]


#: Rows that a feature must occur in to count, and labelled rows from which on these alone tell its odds.
LEAST_ROWS, ENOUGH_ROWS = 3, 10


class Counts:
    """What one view has been given by the other: documents of each class (0, 1), and those that hold each feature."""

    def __init__(self, size: int):
        self.rows, self.features = np.zeros(2), np.zeros((2, size))


def fit(rows: Rows, y: np.ndarray, use: np.ndarray, given: Counts, start: np.ndarray | None = None, steps: int = _STEPS, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and, last, the bias, for the rows in use with labels y and what the other view gave; and
    the same before scaling, as a start for the next fit.

    Each feature is scaled by its smoothed log odds between the classes, which leaves little to features that don't
    tell them apart; those that few labelled rows hold take them from the given documents too. Then logistic regression
    with balanced classes by adaptive gradient steps. Features that no labelled row holds get the mean weight.
    """
    held = [np.bincount(rows.at, (use & (y == c)).astype(float)[rows.row], rows.size) for c in (0, 1)]
    seen = held[0] + held[1]
    taught = seen < ENOUGH_ROWS
    rate = []
    for c in (0, 1):
        mine = (use & (y == c)).sum()
        share = np.where(taught, SHARE * mine / max(1.0, given.rows[c]), 0.0)
        rate.append((held[c] + share * given.features[c] + 1) / (mine + share * given.rows[c] + 2))
    odds = np.log(rate[1]) - np.log(rate[0])
    odds[seen + np.where(taught, given.features.sum(axis=0), 0) < LEAST_ROWS] = 0
    kept = use[rows.row] & (odds[rows.at] != 0)
    at, row = rows.at[kept], rows.row[kept]
    value = rows.value[kept] * odds.astype(np.float32)[at]
    del kept
    w = np.zeros(rows.size + 1) if start is None else start.copy()
    moment, square = np.zeros_like(w), np.zeros_like(w)
    good, bad = (use & (y == 1)).astype(float), (use & (y == 0)).astype(float)
    share = 0.5 * good / max(1.0, good.sum()) + 0.5 * bad / max(1.0, bad.sum())
    for t in range(1, (steps if start is None else steps // 4) + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w.astype(np.float32)[at] * value, rows.n) + w[-1], -30, 30)))
        e = share * (p - y)
        g = np.r_[np.bincount(at, e.astype(np.float32)[row] * value, rows.size) + penalty * w[:-1], e.sum()]
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= (0.05 if start is None else 0.02) * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    size = np.bincount(at, np.abs(value), rows.size)
    w[:-1][seen == 0] = np.sum(w[:-1] * size) / max(1e-9, size.sum())
    return np.append(w[:-1] * odds, w[-1]), w


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the scores (Platt), slightly held to slope 1."""
    a, b = 1.0, 0.0
    if len(set(y.tolist())) < 2:
        return a, b
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        e, d = p - y, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[np.sum(d * z * z) + 1, np.sum(d * z)], [np.sum(d * z), np.sum(d) + 1e-3]])
        step = np.linalg.solve(h, [np.sum(e * z) + (a - 1), np.sum(e)])
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def _sampler(batches):
    for batch in batches:
        texts, meta = [], []
        src, lang = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for part in K.slices(batch.column(1)):
            own = slice(part.first, part.first + len(part))
            for rows, at, out in ((*text_features(part), texts), (*meta_features(part, src[own], lang[own]), meta)):
                out += [x.astype(np.int32) for x in np.split(at, np.cumsum(np.bincount(rows, minlength=len(part)))[:-1])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.list_(pa.int32())), pa.array(meta, pa.list_(pa.int32())), batch.column(4)], ["_key", "text", "meta", "y"])


class Model:
    """Both views and their calibrations; z is the combined log-odds."""

    def __init__(self, text, meta, text_curve, meta_curve):
        self.text, self.meta, self.text_curve, self.meta_curve = text, meta, text_curve, meta_curve

    def views(self, part: K.Slice, source: list, lang: list) -> tuple[tuple, tuple]:
        """Of each view: features (text, bucket) and calibrated log-odds."""
        out = []
        for (rows, at), w, curve in (
            (text_features(part), self.text, self.text_curve), (meta_features(part, source, lang), self.meta, self.meta_curve)
        ):
            z = np.bincount(rows, w[at], len(part)) / np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(part)))) + w[-1]
            out.append((rows, at, curve[0] * z + curve[1]))
        return tuple(out)

    def score(self, part: K.Slice, source: list, lang: list) -> np.ndarray:
        """The text's log-odds and a quarter of the metadata's."""
        (_, _, t), (_, _, m) = self.views(part, source, lang)
        return 1 / (1 + np.exp(-np.clip(t + 0.25 * m, -30, 30)))


def _exchange(shared):
    """Rows (text, source, lang, labelled): counts (view, class, feature) of what each view is given; feature -1: rows."""

    def run(batches):
        model, sure = shared.value, np.log(CONFIDENT / (1 - CONFIDENT))
        sizes = (1 << BITS, 1 << META_BITS)
        held = [np.zeros((2, n + 1), np.int64) for n in sizes]
        for batch in batches:
            src, lang = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            known = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            for part in K.slices(batch.column(0)):
                own = slice(part.first, part.first + len(part))
                views = model.views(part, src[own], lang[own])
                for k in (0, 1):
                    rows, at, _ = views[k]
                    z = views[1 - k][2]
                    for c, picked in ((0, z <= -sure), (1, z >= sure)):
                        picked = picked & ~known[own]
                        held[k][c, -1] += picked.sum()
                        held[k][c, :-1] += np.bincount(at[picked[rows]], minlength=sizes[k])
        for k in (0, 1):
            for c in (0, 1):
                used = np.flatnonzero(held[k][c])
                names = np.where(used == sizes[k], -1, used)
                cols = [np.full(len(used), k), np.full(len(used), c), names, held[k][c][used]]
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], ["view", "y", "feature", "n"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, most_labelled: int = MOST_LABELLED, rounds: int = ROUNDS) -> Model | None:
    """Fit on at most most_labelled labelled documents and on what the views are sure of; None without labelled rows.

    Good rows are those of quality 1 that aren't toxic. An id with several labels counts by its lowest judgement, one
    with several rows by the row whose features have the smallest hash.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "quality")
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("double")
    judged = labels.select(labels[id_col].alias("_key"), labels["quality"], labels["toxic"]).filter("_key IS NOT NULL AND quality IS NOT NULL")
    judged = judged.groupBy("_key").agg(F.min(good).alias("y"))
    # most_labelled narrow rows at most, whatever the input
    chosen = ws.save(judged.orderBy(F.xxhash64("_key"), "_key").limit(most_labelled), "sample")
    marked = docs.join(F.broadcast(chosen), docs[id_col] == chosen["_key"], "left").select("_key", text_col, source_col, lang_col, "y")
    kind = "_key long, text array<int>, meta array<int>, y double"
    table = marked.filter("_key IS NOT NULL").mapInArrow(_sampler, kind).groupBy("_key")
    table = table.agg(F.min_by(F.struct("text", "meta", "y"), F.xxhash64("text", "meta")).alias("s")).select("_key", "s.*")
    table = ws.save(table.withColumn("_size", F.size("text")), "features")
    upto = F.sum("_size").over(Window.orderBy(F.xxhash64("_key"), "_key"))
    few = table.select("_key", "_size").withColumn("_upto", upto).filter(F.col("_upto") <= MOST_FEATURES).select("_key")
    table = table.drop("_size").join(F.broadcast(few), "_key").toPandas()
    if not len(table):
        return None
    table["_crc"] = [zlib.crc32(np.asarray(x, np.int32).tobytes()) for x in table["text"]]
    table = table.sort_values(["_key", "_crc"], kind="stable")
    # copies of a text go to one side
    held, gold = table["_crc"].to_numpy() % 4 == 0, table["y"].to_numpy(float)
    views = Rows(table.pop("text"), 1 << BITS), Rows(table.pop("meta"), 1 << META_BITS)
    given, start = (Counts(1 << BITS), Counts(1 << META_BITS)), (None, None)
    for r in range(rounds + 1):
        weights, start = zip(*(fit(v, gold, ~held, g, s) for v, g, s in zip(views, given, start)))
        curves = [calibrate(v.dot(w)[held], gold[held]) for v, w in zip(views, weights)]
        model = Model(*weights, *curves)
        if r == rounds:
            return model
        shared = spark.sparkContext.broadcast(model)
        rows = marked.select(text_col, source_col, lang_col, F.col("_key").isNotNull().alias("labelled"))
        found = rows.mapInArrow(_exchange(shared), "view long, y long, feature long, n long").groupBy("view", "y", "feature").agg(F.sum("n").alias("n")).toPandas()
        shared.destroy()
        given = Counts(1 << BITS), Counts(1 << META_BITS)
        for k in (0, 1):
            for c in (0, 1):
                mine = found[(found["view"] == k) & (found["y"] == c)]
                given[k].rows[c] = mine.loc[mine["feature"] < 0, "n"].sum()
                mine = mine[mine["feature"] >= 0]
                given[k].features[c][mine["feature"].to_numpy()] = mine["n"]


def _scorer(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            src, lang = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            out = [np.zeros(0)]
            for part in K.slices(batch.column(1)):
                own = slice(part.first, part.first + len(part))
                out.append(model.score(part, src[own], lang[own]) if model else np.full(len(part), 0.5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))], ["_key", "score"])

    return run


def _filter(shared, names: list[str]):
    """Whole rows whose score is accepted."""

    def run(batches):
        model = shared.value
        for batch in batches:
            text, src, lang = (batch.column(batch.schema.get_field_index(c)) for c in names)
            src, lang = src.to_pylist(), lang.to_pylist()
            keep = [np.zeros(0, bool)]
            for part in K.slices(text):
                own = slice(part.first, part.first + len(part))
                keep.append(model.score(part, src[own], lang[own]) >= ACCEPT if model else np.ones(len(part), bool))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return run


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    most_labelled: int = MOST_LABELLED, rounds: int = ROUNDS,
) -> DataFrame:
    """A row per input row: id, score (0 to 1) and accepted (score >= ACCEPT).

    Null or empty text has the score of its metadata and the text bias; null source or language is a value of its own.
    Rows with a null id are scored and exchanged but never count as labelled; repeated rows are scored one by one.
    Without labels every score is 0.5 and all rows are accepted. Other columns are left out. An empty table gives no rows.
    """
    docs = only(docs, id_col, text_col, source_col, lang_col)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, source_col, lang_col, most_labelled, rounds))
    schema = f"_key {docs.schema[id_col].dataType.simpleString()}, score double"
    out = docs.mapInArrow(_scorer(model), schema).withColumnRenamed("_key", id_col)
    return out.withColumn("accepted", F.col("score") >= ACCEPT)


def accepted_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The rows that classify() accepts, with all their columns, in one pass and without a join."""
    model = docs.sparkSession.sparkContext.broadcast(train(only(docs, id_col, text_col, source_col, lang_col), labels, id_col, text_col, source_col, lang_col))
    return docs.mapInArrow(_filter(model, [text_col, source_col, lang_col]), docs.schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: scores of all documents."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

"""Language identification by nearest centroid over normalised TF-IDF vectors of hashed character n-grams."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import kernels as K
from .workspace import Workspace, only

DIMENSIONS = 4096
SIZES = (1, 2, 3)
CENTROIDS = 4
#: Labelled rows a language gives to the fit at most (those with the smallest hashes of their ids), and all together.
ROWS_PER_LANGUAGE, MOST_ROWS = 1000, 6000
#: Languages (those with the most labelled rows) that are learned at most. A language's centroids take 64 KB of every
#: worker's memory; more than these names the world's written languages, so the rest would be noise of the lang column.
MOST_LANGUAGES = 1000
#: A text further from its centroid than this share of the learned texts of that centroid is marked as rejected.
RADIUS = 0.999
UNKNOWN = "und"


def gram_counts(texts: list[str], dims: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed n-grams of code points, lower case, one row per text."""
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    out = np.zeros(len(texts) * dims)
    key = np.zeros(len(data), np.uint64)
    for n in range(1, max(SIZES) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        key = key[:size] * np.uint64(0x100000001B3) + data[n - 1 :]
        if n in SIZES:
            inside = owner[:size] == owner[n - 1 :]
            bucket = ((key ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            out += np.bincount((owner[:size] * dims + (bucket % np.uint64(dims)).astype(np.int64))[inside], minlength=len(out))
    return out.reshape(len(texts), dims)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of (1 + log count) * idf; the zero vector for a text without n-grams."""
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _chunks(texts: list[str | None], chars: int = 400_000):
    """Whole texts, lower case, with a space for all between letters, in chunks of bounded length and number."""
    held: list[str] = []
    n = 0
    for t in texts:
        held.append(_NOT_LETTERS.sub(" ", (t or "").lower()))
        n += len(held[-1])
        if n >= chars or len(held) >= 256:
            yield held
            held, n = [], 0
    if held:
        yield held


def _vectors(batches):
    for batch in batches:
        at = 0
        texts = batch.column(1).to_pylist()
        for chunk in _chunks(texts):
            counts = gram_counts(chunk)
            rows = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(chunk)),
                    pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    pa.array([c[r].astype(np.float32) for c, r in zip(counts, rows)], pa.list_(pa.float32())),
                ],
                ["lang", "at", "n"],
            )
            at += len(chunk)


def cluster(vectors: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Centroids of spherical k-means, started from far-apart vectors."""
    k = min(k, len(vectors))
    chosen = [seed % len(vectors)]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        best = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[best == c].sum(axis=0) if (best == c).any() else centres[c] for c in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


class Model:
    """Languages in order, their centroids (one row each), the language of each row, idf, and each row's radius."""

    def __init__(self, langs: list[str], rows: list[tuple[str, np.ndarray, np.ndarray]]):
        self.langs = langs
        held = np.zeros(DIMENSIONS)
        for _, at, _ in rows:
            held[at] += 1
        self.idf = (np.log((1 + len(rows)) / (1 + held)) + 1).astype(np.float32)
        centres, owners, radii = [], [], []
        for k, lang in enumerate(langs):
            own = [r for r in rows if r[0] == lang]
            counts = np.zeros((len(own), DIMENSIONS), np.float32)
            for i, (_, at, n) in enumerate(own):
                counts[i, at] = n
            v = weigh(counts, self.idf).astype(np.float32)
            c = cluster(v, CENTROIDS, k)
            best = v @ c.T
            for j in range(len(c)):
                own = best[np.argmax(best, axis=1) == j, j]
                centres.append(c[j]), owners.append(k), radii.append(float(np.quantile(1 - own, RADIUS)) if len(own) else 0.0)
        self.centres = np.array(centres, np.float32).reshape(-1, DIMENSIONS)
        self.owners, self.radii = np.array(owners, np.int64), np.array(radii)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid's language, cosine, and whether it lies beyond that centroid's radius."""
        similar = weigh(counts, self.idf) @ self.centres.T
        best = np.argmax(similar, axis=1)
        score = np.clip(similar[np.arange(len(best)), best], 0, 1).astype(float)
        return self.owners[best], score, 1 - score > self.radii[best] * 1.05 + 1e-6


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most_languages: int = MOST_LANGUAGES) -> Model:
    """Fit on labelled rows that aren't held out: at most ROWS_PER_LANGUAGE of each language and MOST_ROWS of all.

    Rows of one id and text count once, so neither a repeated id nor a repeated text makes the sample larger.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "langid")
    usable = docs.filter(~held_out(id_col) & docs[lang_col].isNotNull() & docs[id_col].isNotNull())
    usable = usable.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"), F.xxhash64(id_col, lang_col, text_col).alias("_h"))
    langs = usable.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_lang").limit(most_languages).collect()
    sizes = {r[0]: r[1] for r in langs}
    langs = sorted(sizes)
    most_rows = max(1, min(ROWS_PER_LANGUAGE, MOST_ROWS // max(1, len(langs))))
    # rows of large languages are thinned by hash before they are ranked: half as many again as are wanted go on
    part = F.pmod(F.xxhash64("_h"), F.lit(1 << 30)) / float(1 << 30)
    most = F.create_map(*[F.lit(x) for k in langs for x in (k, 1.5 * most_rows / sizes[k])]) if langs else None
    rows = usable.filter(F.col("_lang").isin(langs) & (part < most[F.col("_lang")]) if langs else F.lit(False))
    rows = rows.groupBy("_lang", "_h").agg(F.min("_id").alias("_id"))
    order = Window.partitionBy("_lang").orderBy("_h")
    chosen = ws.save(rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= most_rows).select("_h"), "sample")
    # at most MOST_ROWS narrow rows (and one of each language), whatever the input
    rows = usable.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.min_by(F.struct("_lang", "_text"), "_id").alias("s")).select("s._lang", "s._text")
    rows = rows.mapInArrow(_vectors, "lang string, at array<int>, n array<float>").toPandas()
    rows = sorted(((r.lang, np.asarray(r.at, np.int64), np.asarray(r.n, np.float32)) for r in rows.itertuples()), key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    return Model([k for k in langs if any(r[0] == k for r in rows)], rows)


def _predictor(shared):
    def run(batches):
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], object)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            letters = np.fromiter((t is not None and next(filter(str.isalpha, t), None) is not None for t in texts), bool, len(texts))
            which, score, far = [], [], []
            for chunk in _chunks(texts):
                if model.langs:
                    a, b, c = model.predict(gram_counts(chunk))
                else:
                    a, b, c = np.zeros(len(chunk), np.int64), np.zeros(len(chunk)), np.ones(len(chunk), bool)
                which.append(a), score.append(b), far.append(c)
            which = np.where(letters & bool(model.langs), np.concatenate(which or [np.zeros(0, np.int64)]), len(model.langs))
            score = np.where(letters, np.concatenate(score or [np.zeros(0)]), 0.0)
            far = np.concatenate(far or [np.zeros(0, bool)]) | ~letters
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[which], pa.string()), pa.array(score), pa.array(far)], ["_id", "lang_pred", "score", "rejected"])

    return run


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_languages: int = MOST_LANGUAGES,
) -> DataFrame:
    """A row per document: id, held_out, lang_pred, score (cosine to the centroid), rejected (too far from it).

    Null text and text without a letter: und, score 0, rejected. Rows with a null id are never learned from, never
    held out, and predicted like others. Without learnable rows everything is und. Other columns are left out. Ties
    go to the language that sorts first.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(only(docs, id_col, text_col, lang_col), id_col, text_col, lang_col, most_languages))
    docs = only(docs, id_col, text_col)
    schema = f"_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    out = docs.mapInArrow(_predictor(model), schema).withColumnRenamed("_id", id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score", "rejected")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query: the language of every document."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))

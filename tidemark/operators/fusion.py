"""Fusion, re-ranking and pooling over the rankings table (query_id, encoder, enc_ord, rank, chunk_id, sim).

Equal scores keep the order of first appearance: encoder order, then rank in that encoder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config

MODES = ("rrf", "combsum", "combmnz", "convex")


def threshold(rankings: DataFrame, share: float | None) -> DataFrame:
    """Rows of at least this share of the best similarity of their query and encoder; ranks stay.

    Off for no share, and where the best similarity isn't above 0.
    """
    if not share:
        return rankings
    best = F.max("sim").over(Window.partitionBy("query_id", "encoder"))
    return rankings.withColumn("_best", best).filter((F.col("_best") <= 0) | (F.col("sim") >= share * F.col("_best"))).drop("_best")


def depth(rankings: DataFrame, k: int) -> DataFrame:
    """The first k ranks: what a search of depth k would have found."""
    return rankings.filter(F.col("rank") <= k)


def fuse(rankings: DataFrame, mode: str = "rrf", k0: int = config.RRF_K0, weights: dict[str, float] | None = None) -> DataFrame:
    """Candidates: query_id, chunk_id, score, consensus, positions (encoder -> rank), pos (place in the fused order)."""
    if mode not in MODES:
        raise ValueError(f"unknown fusion {mode}")
    rows = rankings
    if mode == "convex":
        pool = Window.partitionBy("query_id", "encoder")
        low, high = F.min("sim").over(pool), F.max("sim").over(pool)
        value = F.when(high == low, 1.0).otherwise((F.col("sim") - low) / (high - low))
        for name, weight in (weights or {}).items():
            value = value * F.when(F.col("encoder") == name, float(weight)).otherwise(1.0)
        rows = rows.withColumn("_value", value)
    elif mode == "rrf":
        rows = rows.withColumn("_value", 1.0 / (k0 + F.col("rank")))
    else:
        rows = rows.withColumn("_value", F.col("sim"))
    total = F.sum("_value")
    if mode == "combmnz":
        total = total * F.count("encoder")
    first = F.min(F.struct("enc_ord", "rank"))
    out = rows.groupBy("query_id", "chunk_id").agg(
        F.round(total, config.TAU_DIGITS).alias("score"), F.count("encoder").alias("consensus"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("encoder", "rank")))).alias("positions"), first.alias("_first"),
    )
    return place(out, F.desc("score"), "_first.enc_ord", "_first.rank").drop("_first")


def place(candidates: DataFrame, *order: Column | str) -> DataFrame:
    return candidates.withColumn("pos", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))


def boost(candidates: DataFrame, factor: float = config.BOOST) -> DataFrame:
    """Raise chunks of the query's own phenomenon (columns fenomeno and query_fenomeno), and order again."""
    hit = F.coalesce(F.col("fenomeno") == F.col("query_fenomeno"), F.lit(False))
    out = candidates.withColumn("score", F.round(F.when(hit, F.col("score") * factor).otherwise(F.col("score")), config.TAU_DIGITS))
    return place(out, F.desc("score"), "pos")


def text_key(text: Column) -> Column:
    """Lower case with white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def distinct_texts(candidates: DataFrame) -> DataFrame:
    """The best candidate of each text."""
    key = Window.partitionBy("query_id", text_key(F.col("texto"))).orderBy("pos")
    out = candidates.withColumn("_n", F.row_number().over(key)).filter("_n = 1").drop("_n")
    return place(out, "pos")


def diversify(candidates: DataFrame, limit: int, per_doc: int = config.PER_DOC) -> DataFrame:
    """At most per_doc of a document, then the best of those left out, up to limit."""
    inside = Window.partitionBy("query_id", "doc_id").orderBy("pos")
    out = candidates.withColumn("_late", F.row_number().over(inside) > per_doc)
    return place(out, "_late", "pos").filter(F.col("pos") <= limit).drop("_late")


def document_score(scores: Column, mode: str, strict: bool = False) -> Column:
    """Score of a document from its candidates' scores, best first: max, suma, media or topN.

    An unknown mode counts as max, or is an error if strict (which also leaves out suma and media).
    """
    if mode.startswith("top") and mode[3:].isdigit() and int(mode[3:]) > 0:
        best = F.slice(scores, 1, int(mode[3:]))
        return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.size(best)
    if strict and mode != "max":
        raise ValueError(f"unknown aggregation {mode}")
    if mode == "suma":
        return F.aggregate(scores, F.lit(0.0), lambda s, x: s + x)
    if mode == "media":
        return F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / F.size(scores)
    return F.element_at(scores, 1)


def pool_documents(candidates: DataFrame, top: int = config.TOP_DOCUMENTS, mode: str = config.AGGREGATION, strict: bool = False) -> DataFrame:
    """(query_id, rank, doc_id, fuente, score): sources by pooled score, each with the document of its best candidate."""
    key = F.coalesce(F.nullif("fuente", F.lit("")), F.col("doc_id").cast("string"))
    groups = candidates.withColumn("_key", key).groupBy("query_id", "_key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "score"))).alias("_all"), F.min_by("doc_id", "pos").alias("doc_id"), F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    scores = F.reverse(F.array_sort(F.col("_all")["score"]))
    total = F.round(document_score(scores, mode, strict) + F.col("_n") * 1e-9, config.TAU_DIGITS + 2)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "_first")
    out = groups.withColumn("score", total).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return out.select("query_id", "rank", "doc_id", F.col("_key").alias("fuente"), "score")


def reorder(
    rankings: DataFrame, chunks: DataFrame, queries: DataFrame, fusion: str = "rrf", aggregation: str = config.AGGREGATION,
    share: float | None = None, k0: int = config.RRF_K0, factor: float = config.BOOST, per_doc: int = config.PER_DOC,
    top_fragments: int = config.TOP_FRAGMENTS, top_documents: int = config.TOP_DOCUMENTS,
) -> tuple[DataFrame, DataFrame]:
    """Fragments (three times the asked number, for the output stage to choose from) and documents of every query."""
    fused = fuse(threshold(rankings, share), fusion, k0)
    named = fused.join(chunks.select("chunk_id", "doc_id", "fuente", "fenomeno", "texto"), "chunk_id")
    named = boost(named.join(queries.select("query_id", F.col("fenomeno").alias("query_fenomeno")), "query_id"), factor)
    fragments = diversify(distinct_texts(named), 3 * top_fragments, per_doc)
    return fragments, pool_documents(named, top_documents, aggregation)


def dual_policy(rankings: DataFrame, chunks: DataFrame, queries: DataFrame, fragment_encoders: list[str], document_encoders: list[str], **options) -> tuple[DataFrame, DataFrame]:
    """Fragments by reciprocal ranks over some encoders, documents by convex fusion over others."""
    fragments, _ = reorder(rankings.filter(F.col("encoder").isin(fragment_encoders)), chunks, queries, "rrf", **options)
    _, documents = reorder(rankings.filter(F.col("encoder").isin(document_encoders)), chunks, queries, "convex", **options)
    return fragments, documents


def retrieve(indices: dict[str, DataFrame], query_vectors: dict[str, DataFrame], chunks: DataFrame, queries: DataFrame, k: int = config.CANDIDATES, **options) -> tuple[DataFrame, DataFrame]:
    """Search and reorder in one call."""
    from tidemark.operators.search import search_all

    return reorder(search_all(indices, query_vectors, k), chunks, queries, **options)

"""Pools for judgment, consolidation of judgments, and stratified samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config


def pool(rankings: DataFrame, depth: int = config.POOL_DEPTH) -> DataFrame:
    """(query_id, chunk_id, posiciones, sims, mejor): the union of the encoders' first ranks."""
    rows = rankings.filter(F.col("rank") <= depth).groupBy("query_id", "chunk_id")
    return rows.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("encoder", "rank")))).alias("posiciones"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("encoder", "sim")))).alias("sims"), F.min("rank").alias("mejor"),
    )


def annotation_pool(rankings: DataFrame, annotators: int, depth: int = 20, shared: float = 0.2) -> DataFrame:
    """(query_id, chunk_id, encoder, rank, anotador): the first encoder that has a chunk; queries are dealt in turn, and
    the first share of them goes to a second annotator too."""
    first = Window.partitionBy("query_id", "chunk_id").orderBy("enc_ord")
    rows = rankings.filter(F.col("rank") <= depth).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    ids = rows.select("query_id").distinct()
    order = Window.partitionBy(F.lit(1)).orderBy("query_id")
    ids = ids.withColumns({"_i": F.row_number().over(order) - 1, "_all": F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))})
    owner = F.pmod(F.col("_i"), F.lit(annotators))
    both = F.when((F.col("_i") < F.floor(F.col("_all") * shared)) & F.lit(annotators > 1), F.array(owner, F.pmod(owner + 1, F.lit(annotators)))).otherwise(F.array(owner))
    ids = ids.select("query_id", F.explode(both).alias("anotador"))
    return rows.join(ids, "query_id").select("query_id", "chunk_id", "encoder", "rank", "anotador")


def consolidate(grades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """grades (query_id, chunk_id, doc_id, grade as text): highest legible grade per chunk, documents with a grade of 2."""
    rows = grades.withColumn("grade", F.trim("grade").try_cast("double")).filter(F.col("grade").isNotNull())
    best = rows.groupBy("query_id", "chunk_id").agg(F.max("grade").alias("grade"))
    docs = rows.filter(F.col("grade") >= 2).select("query_id", "doc_id").distinct()
    return best, docs


def consolidate_latest(pooled: DataFrame, judged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """judged (query_id, chunk_id, grade, doc, ord): the last judgment of pooled chunks; documents forced by one of them
    or graded 2; and the pooled chunks that nobody judged. Judgments outside the pool are left out."""
    keys = ["query_id", "chunk_id"]
    known = judged.join(pooled.select(*keys).distinct(), keys, "left_semi")
    last = known.groupBy(*keys).agg(F.max_by("grade", "ord").alias("grade"), F.max_by("doc", "ord").alias("doc"))
    docs = last.filter(F.coalesce("doc", F.lit(False)) | (F.col("grade") >= 2)).select(*keys)
    return last.select(*keys, "grade"), docs, pooled.select(*keys).join(judged.select(*keys), keys, "left_anti")


def batches(pooled: DataFrame, queries_per_batch: int = 5) -> DataFrame:
    """The pool with lote, a number for every few queries."""
    order = Window.partitionBy(F.lit(1)).orderBy("query_id")
    ids = pooled.select("query_id").distinct().withColumn("lote", (F.floor((F.row_number().over(order) - 1) / queries_per_batch) + 1).cast("int"))
    return pooled.join(ids, "query_id")


def doc_stats(chunks: DataFrame) -> DataFrame:
    """Chunks per document and its attributes as its first chunk has them."""
    return chunks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("fragmentos"), F.min_by("fenomeno", "chunk_id").alias("fenomeno"), F.min_by("fuente", "chunk_id").alias("fuente"))


def mandatory(relevant: DataFrame, judged_chunks: DataFrame) -> DataFrame:
    """Relevant documents and those of judged chunks."""
    return relevant.select("doc_id").unionByName(judged_chunks.select("doc_id")).distinct()


def running_total(column: str, *order):
    """Sum over the rows before this one."""
    w = Window.partitionBy(F.lit(1)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(w), F.lit(0))


def hard_negatives(rankings: DataFrame, already: DataFrame, docs: DataFrame, most: int, goal: int, have: int = 0) -> DataFrame:
    """Documents outside `already` by their best rank, until there are `most` or their fragments reach the goal."""
    best = rankings.join(already, "doc_id", "left_anti").groupBy("doc_id").agg(F.min("rank").alias("mejor"))
    # the running total needs the first `most` rows only
    rows = best.join(docs.select("doc_id", "fragmentos"), "doc_id").orderBy("mejor", "doc_id").limit(most)
    rows = rows.withColumn("_sum", running_total("fragmentos", "mejor", "doc_id"))
    return rows.filter(F.col("_sum") + have < goal).select("doc_id", "mejor", "fragmentos")


def stratified(docs: DataFrame, goal: int, per_round: int = 10, strata: tuple[str, ...] = ("fenomeno", "formato")) -> DataFrame:
    """docs (doc_id, fragmentos, strata, orden): rounds take from each stratum in turn, in proportion to its size, until
    the fragments reach the goal. Every document has a fragment at least, so no more than `goal` rows are looked at in
    one order, and no more than `goal` of a stratum are ranked."""
    sizes = docs.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("_all"))
    quota = F.greatest(F.lit(1), F.rint(F.lit(float(per_round)) * F.col("_n") / F.col("_all")).cast("int"))
    sizes = sizes.crossJoin(F.broadcast(total)).select(*strata, quota.alias("_q"))  # one row of totals
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy("orden", "doc_id"))
    rows = docs.withColumn("_rn", rank).filter(F.col("_rn") <= goal).join(sizes, list(strata))
    rows = rows.withColumn("ronda", F.floor((F.col("_rn") - 1) / F.col("_q")).cast("int")).orderBy("ronda", *strata, "_rn").limit(goal)
    rows = rows.withColumn("_sum", running_total("fragmentos", "ronda", *strata, "_rn"))
    return rows.filter(F.col("_sum") < goal).select(*docs.columns, "ronda")


def coverage(chosen: DataFrame, judged_chunks: DataFrame, relevant: DataFrame) -> DataFrame:
    """(juicios, juicios_dentro, docs, docs_dentro) of a sample of documents."""
    mark = chosen.select("doc_id", F.lit(1).alias("_in")).distinct()
    a = judged_chunks.join(mark, "doc_id", "left").agg(F.count(F.lit(1)).alias("juicios"), F.count("_in").alias("juicios_dentro"))
    b = relevant.select("doc_id").distinct().join(mark, "doc_id", "left").agg(F.count(F.lit(1)).alias("docs"), F.count("_in").alias("docs_dentro"))
    return a.crossJoin(b)

"""Retrieval metrics over ranked results and judgments, and comparisons of runs.

Judgments are two tables: fragments (query_id, chunk_id, grade) and documents (query_id, fuente).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.sources.lineage import cut


def dcg(grade: Column, rank: Column) -> Column:
    """Aggregate: sum of grade / log2(rank + 1)."""
    return F.sum(grade / F.log2(rank + 1))


def ideal(counts: DataFrame, k: int) -> DataFrame:
    """(query_id, ideal) of the k best grades; counts: query_id, grade, n. A query has few different grades, so its
    judgments are counted where they are read and never sorted."""
    upto = F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("grade")).rowsBetween(Window.unboundedPreceding, 0))
    rows = counts.withColumn("_upto", upto).filter(F.col("_upto") - F.col("n") < k)
    rows = rows.withColumn("_r", F.explode(F.sequence(F.col("_upto") - F.col("n") + 1, F.least(F.col("_upto"), F.lit(k)))))
    return rows.groupBy("query_id").agg(dcg(F.col("grade"), F.col("_r")).alias("ideal"))


def ndcg(results: DataFrame, qrels: DataFrame, k: int = config.TOP_FRAGMENTS) -> DataFrame:
    """(query_id, ndcg) of every judged query that has results; the ideal takes all judged grades."""
    best = ideal(qrels.groupBy("query_id", "grade").agg(F.count(F.lit(1)).alias("n")), k)
    got = results.filter(F.col("rank") <= k).join(qrels, ["query_id", "chunk_id"], "left")
    got = got.groupBy("query_id").agg(dcg(F.coalesce("grade", F.lit(0.0)), F.col("rank")).alias("dcg"))
    return got.join(best, "query_id").select("query_id", F.coalesce(F.try_divide("dcg", F.nullif("ideal", F.lit(0.0))), F.lit(0.0)).alias("ndcg"))


def f1(results: DataFrame, relevant: DataFrame, k: int = config.TOP_DOCUMENTS, key: str = "fuente") -> DataFrame:
    """(query_id, f1): hits over k, and over the smaller of k and the number of relevant ones; a repeated hit counts once."""
    sizes = relevant.groupBy("query_id").agg(F.countDistinct(key).alias("_r"))
    hits = results.filter(F.col("rank") <= k).select("query_id", key).distinct().join(relevant.select("query_id", key).distinct(), ["query_id", key])
    hits = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("_h"))
    rows = results.select("query_id").distinct().join(sizes, "query_id").join(hits, "query_id", "left").na.fill(0, ["_h"])
    p, r = F.col("_h") / F.lit(k), F.col("_h") / F.least(F.col("_r"), F.lit(k))
    return rows.select("query_id", F.coalesce(F.try_divide(2 * p * r, F.nullif(p + r, F.lit(0.0))), F.lit(0.0)).alias("f1"))


def evaluate(fragments: DataFrame, documents: DataFrame, qrels: DataFrame, relevant: DataFrame, answered: DataFrame | None = None) -> DataFrame:
    """(query_id, ndcg, f1) of answered queries that are judged, not rounded; 0 where nothing was returned or is relevant.

    answered: query_id of all queries with a result; by default those with a fragment or a document.
    """
    ids = lambda *tables: reduce(DataFrame.unionByName, [t.select("query_id") for t in tables]).distinct()
    rows = ids(*([answered] if answered is not None else [fragments, documents])).join(ids(qrels, relevant), "query_id")
    return rows.join(ndcg(fragments, qrels), "query_id", "left").join(f1(documents, relevant), "query_id", "left").na.fill(0.0, ["ndcg", "f1"])


def summary(per_query: DataFrame) -> DataFrame:
    return per_query.agg(F.round(F.avg("ndcg"), 4).alias("ndcg"), F.round(F.avg("f1"), 4).alias("f1"), F.count(F.lit(1)).alias("queries"))


def intervals(per_query: DataFrame) -> DataFrame:
    """(metric, mean, low, high): means with their bootstrap intervals, queries in the order of their ids."""
    from tidemark.functions.stats import bootstrap_interval

    rows = per_query.select("query_id", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in ("ndcg", "f1")])).alias("r"))
    lists = rows.groupBy("r.metric").agg(F.avg("r.x").alias("mean"), F.array_sort(F.collect_list(F.struct("query_id", "r.x"))).alias("v"))
    out = lists.select("metric", F.round("mean", 4).alias("mean"), bootstrap_interval(F.col("v")["x"]).alias("i"))
    return out.select("metric", "mean", F.round("i.low", 4).alias("low"), F.round("i.high", 4).alias("high"))


def by_phenomenon(per_query: DataFrame) -> DataFrame:
    """Means and counts by phenomenon; queries without one are left out."""
    rows = per_query.filter(F.col("fenomeno").isNotNull()).groupBy("fenomeno")
    return rows.agg(F.round(F.avg("ndcg"), 6).alias("ndcg"), F.round(F.avg("f1"), 6).alias("f1"), F.count(F.lit(1)).alias("n"))


def borda(runs: DataFrame, metrics: tuple[str, ...] = ("ndcg", "f1")) -> DataFrame:
    """runs (idx, metrics...) with points: for each metric the number of runs minus the place, ties by idx."""
    everything = Window.partitionBy(F.lit(1))
    points = sum(F.count(F.lit(1)).over(everything) - F.row_number().over(everything.orderBy(F.desc(m), "idx")) for m in metrics)
    return runs.withColumn("puntos", points)


def indistinguishable(runs: DataFrame, half: float | None = None) -> DataFrame:
    """Pairs of runs (a < b) whose intervals overlap on both metrics; runs has idx, ndcg_lo, ndcg_hi, f1_lo, f1_hi.

    Where all intervals have one half width, runs has idx, ndcg and f1, and distances are compared: bounds made of them
    would be rounded once more, and intervals that just touch would be told apart by it.
    """
    a, b = runs.alias("a"), runs.alias("b")
    if half is not None:
        meet = lambda m: F.abs(F.col(f"a.{m}") - F.col(f"b.{m}")) <= F.lit(2.0 * half)
    else:
        meet = lambda m: (F.col(f"a.{m}_lo") <= F.col(f"b.{m}_hi")) & (F.col(f"b.{m}_lo") <= F.col(f"a.{m}_hi"))
    return a.join(b, (F.col("a.idx") < F.col("b.idx")) & meet("ndcg") & meet("f1")).select(F.col("a.idx").alias("a"), F.col("b.idx").alias("b"))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(solape): mean over queries of the share of a's keys that b has too."""
    left = a.groupBy("query_id").agg(F.collect_set(key).alias("_a"))
    right = b.groupBy("query_id").agg(F.collect_set(key).alias("_b"))
    share = F.size(F.array_intersect("_a", "_b")) / F.size("_a")
    return left.join(right, "query_id").agg(F.round(F.avg(share), 6).alias("solape"))


def recall(seen: DataFrame, relevant: DataFrame, key: str) -> DataFrame:
    """(query_id, recall) of queries with relevant keys."""
    n = relevant.select("query_id", key).distinct().groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    hits = relevant.select("query_id", key).distinct().join(seen.select("query_id", key).distinct(), ["query_id", key])
    hits = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("_h"))
    return n.join(hits, "query_id", "left").select("query_id", (F.coalesce("_h", F.lit(0)) / F.col("_n")).alias("recall"))


def verdict(recall: Column, metric: Column) -> Column:
    return F.when(recall - metric < 0.05, "sin margen").when(recall >= 0.9, "ordenamiento").otherwise("recuperacion")


def recall_by_depth(rankings: DataFrame, relevant: DataFrame, depths: list[int], key: str = "fuente") -> DataFrame:
    """(encoder, depth, recall): mean recall of each encoder and of their union at each depth; rankings has key."""
    spark = rankings.sparkSession
    grid = spark.createDataFrame([(d,) for d in depths], "depth int")
    # the depths are a fixed few
    rows = rankings.join(F.broadcast(grid), F.col("rank") <= F.col("depth"))
    rows = rows.select("query_id", "encoder", "depth", key).unionByName(rows.select("query_id", F.lit("union").alias("encoder"), "depth", key)).distinct()
    wanted = relevant.select("query_id", key).distinct()
    total = wanted.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    hits = rows.join(wanted, ["query_id", key], "left_semi").groupBy("query_id", "encoder", "depth").agg(F.count(F.lit(1)).alias("_h"))
    every = rows.select("encoder", "depth").distinct().crossJoin(F.broadcast(total))
    out = every.join(hits, ["query_id", "encoder", "depth"], "left")
    return out.groupBy("encoder", "depth").agg(F.round(F.avg(F.coalesce("_h", F.lit(0)) / F.col("_n")), 6).alias("recall"))


def oracle_order(pool: DataFrame, qrels: DataFrame, limit: int = config.TOP_FRAGMENTS, per_doc: int = config.PER_DOC) -> DataFrame:
    """The pool (query_id, chunk_id, doc_id, pos) in the order of the true grades, with the cap per document: an upper bound."""
    from tidemark.operators.fusion import diversify, place

    graded = pool.join(qrels, ["query_id", "chunk_id"], "left").withColumn("grade", F.coalesce("grade", F.lit(0.0)))
    out = diversify(place(graded, F.desc("grade"), "pos"), limit, per_doc)
    return out.withColumnRenamed("pos", "rank")


def kappa(pairs: DataFrame) -> DataFrame:
    """(kappa) of pairs (a, b): chance-corrected agreement; 1 where chance agrees fully, null without pairs."""
    n = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"))
    left = pairs.groupBy(F.col("a").alias("v")).agg(F.count(F.lit(1)).alias("na"))
    right = pairs.groupBy(F.col("b").alias("v")).agg(F.count(F.lit(1)).alias("nb"))
    chance = left.join(right, "v").agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("both"))
    po, pe = F.col("same") / F.col("n"), F.col("both") / (F.col("n") * F.col("n"))
    value = F.when(F.col("n") == 0, None).when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe))
    return n.filter("n > 0").crossJoin(chance).select(F.round(value, 6).alias("kappa"))


def agreement(grades: DataFrame, least: int = 20) -> DataFrame:
    """(a, b, n, kappa) of annotator pairs with enough items in common; grades has annotator, item, grade."""
    x, y = grades.alias("x"), grades.alias("y")
    both = x.join(y, (F.col("x.item") == F.col("y.item")) & (F.col("x.annotator") < F.col("y.annotator")))
    both = both.select(F.col("x.annotator").alias("a"), F.col("y.annotator").alias("b"), F.col("x.grade").alias("ga"), F.col("y.grade").alias("gb"))
    sizes = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ga") == F.col("gb")).alias("same")).filter(F.col("n") >= least)
    ma = both.groupBy("a", "b", F.col("ga").alias("v")).agg(F.count(F.lit(1)).alias("na"))
    mb = both.groupBy("a", "b", F.col("gb").alias("v")).agg(F.count(F.lit(1)).alias("nb"))
    chance = ma.join(mb, ["a", "b", "v"]).groupBy("a", "b").agg(F.sum(F.col("na") * F.col("nb")).alias("both"))
    po, pe = F.col("same") / F.col("n"), F.coalesce("both", F.lit(0)) / (F.col("n") * F.col("n"))
    return sizes.join(chance, ["a", "b"], "left").select("a", "b", "n", F.round(F.when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe)), 6).alias("kappa"))


def against_base(runs: DataFrame, base: int) -> DataFrame:
    """runs (idx, ndcg, f1) against one of them: gana, pierde or mixto, and the corrected significance level."""
    b = runs.filter(F.col("idx") == base).select(F.col("ndcg").alias("_n"), F.col("f1").alias("_f"))
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    dn, df = F.col("ndcg") - F.col("_n"), F.col("f1") - F.col("_f")
    word = F.when(F.least(dn, df) > 0, "gana").when(F.greatest(dn, df) < 0, "pierde").otherwise("mixto")
    rows = runs.withColumn("umbral", F.round(F.lit(0.05) / F.greatest(2 * (n - 1), F.lit(1)), 6)).crossJoin(F.broadcast(b))
    return rows.filter(F.col("idx") != base).select("idx", F.round(dn, 6).alias("d_ndcg"), F.round(df, 6).alias("d_f1"), word.alias("veredicto"), "umbral")


def evaluate_by_text(fragments: DataFrame, documents: DataFrame, judged: DataFrame, relevant: DataFrame, passages: DataFrame | None = None) -> DataFrame:
    """(query_id, ndcg, f1) where fragments (query_id, rank, chunk_id, text) get the grade of the judged passages
    (query_id, judged_id, grade, texto) they overlap. Judgments without text leave the ideal too. Where passages
    (judged_id, texto) are given, judged needs no texto: a passage that many queries judge is then read once."""
    from tidemark.operators.matching import best_grades, judged_matches

    fragments = cut(fragments)
    texts = fragments.select("query_id", "chunk_id", F.col("text").alias("texto")).dropDuplicates(["query_id", "chunk_id"])
    said, counts = judged_matches(texts, judged, "chunk_id", config.MATCH_THRESHOLD, passages)
    counts = cut(counts)
    graded = best_grades(texts, said, counts, "chunk_id")
    best = ideal(counts.groupBy("query_id", "grade").agg(F.sum("n").alias("n")), config.TOP_FRAGMENTS)
    got = fragments.filter(F.col("rank") <= config.TOP_FRAGMENTS).join(graded, ["query_id", "chunk_id"]).groupBy("query_id").agg(dcg(F.col("grade"), F.col("rank")).alias("dcg"))
    scored = got.join(best, "query_id").select("query_id", F.coalesce(F.try_divide("dcg", F.nullif("ideal", F.lit(0.0))), F.lit(0.0)).alias("ndcg"))
    return scored.join(f1(documents, relevant), "query_id")

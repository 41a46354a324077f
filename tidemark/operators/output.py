"""From ranked fragments to result records of a fixed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.text import sentences, truncate_words, word_count


def pieces(text: Column, most: int = config.FRAGMENT_WORDS) -> Column:
    """Array of pieces of at most so many words: whole sentences while they fit, a longer sentence by words."""
    units = F.flatten(
        F.transform(
            sentences(text),
            lambda s: F.transform(
                F.sequence(F.lit(0), F.greatest(F.floor((word_count(s) - 1) / most), F.lit(0)).cast("int")),
                lambda k: F.array_join(F.slice(F.split(s, r"(?U)\s+"), k * most + 1, most), " "),
            ),
        )
    )
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def add(state: Column, s: Column) -> Column:
        n = word_count(s).cast("int")
        fits = (state["n"] + n <= most) & (state["n"] > 0)
        closed = F.when(state["n"] > 0, F.array_append(state["out"], state["cur"])).otherwise(state["out"])
        return F.struct(
            F.when(fits | (state["n"] == 0), state["out"]).otherwise(closed).alias("out"),
            F.when(fits, F.concat(state["cur"], F.lit(" "), s)).otherwise(s).alias("cur"),
            F.when(fits, state["n"] + n).otherwise(n).alias("n"),
        )

    return F.aggregate(units, empty, add, lambda st: F.when(st["n"] > 0, F.array_append(st["out"], st["cur"])).otherwise(st["out"]))


def emit_fragments(
    candidates: DataFrame, top: int = config.TOP_FRAGMENTS, most: int = config.FRAGMENT_WORDS, split: bool = False, per_doc: int = config.PER_DOC, first_piece: bool = False,
) -> DataFrame:
    """(query_id, rank, chunk_id, doc_id, text): truncated or split fragments (or the first piece of the split ones), at most per_doc positions of a document,
    then what that left out, in order, until there are enough."""
    texts = pieces(F.col("texto"), most) if split else F.array(truncate_words(F.col("texto"), most))
    texts = F.slice(pieces(F.col("texto"), most), 1, 1) if first_piece else texts
    rows = candidates.withColumn("_texts", texts).select("query_id", "chunk_id", "doc_id", "pos", F.posexplode("_texts").alias("piece", "text"))
    inside = Window.partitionBy("query_id", "doc_id").orderBy("pos", "piece")
    rows = rows.withColumn("_late", F.row_number().over(inside) > per_doc)
    best = Window.partitionBy("query_id").orderBy("_late", "pos", "piece")
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "chunk_id", "doc_id", "text")


def pad(rows: DataFrame, n: int) -> DataFrame:
    """Repeat the last row of each query until it has n; a query without rows stays without."""
    last = F.max("rank").over(Window.partitionBy("query_id"))
    upto = F.when(F.col("rank") == F.col("_last"), F.greatest(F.lit(n), F.col("rank"))).otherwise(F.col("rank"))
    out = rows.withColumn("_last", last).withColumn("rank", F.explode(F.sequence(F.col("rank"), upto)))
    return out.drop("_last")


def records(fragments: DataFrame, documents: DataFrame, top_fragments: int = config.TOP_FRAGMENTS, top_documents: int = config.TOP_DOCUMENTS) -> DataFrame:
    """(query_id, documents, fragments): arrays of structs by rank, padded to their fixed sizes."""
    docs = pad(documents.select("query_id", "rank", "doc_id"), top_documents).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents")
    )
    frags = pad(fragments, top_fragments).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments")
    )
    return docs.join(frags, "query_id", "full")


def problems(results: DataFrame, expected: int, top_fragments: int = config.TOP_FRAGMENTS, top_documents: int = config.TOP_DOCUMENTS, most: int = config.FRAGMENT_WORDS) -> DataFrame:
    """(query_id, problem) rows; none if the results are sound."""
    checks = {
        "query_id missing": F.col("query_id").isNull(),
        "wrong number of documents": F.coalesce(F.size("documents"), F.lit(0)) != top_documents,
        "wrong number of fragments": F.coalesce(F.size("fragments"), F.lit(0)) != top_fragments,
        "fragment field missing": F.exists("fragments", lambda f: f["chunk_id"].isNull() | f["doc_id"].isNull() | f["text"].isNull()),
        "fragment too long": F.exists("fragments", lambda f: word_count(f["text"]) > most),
    }
    found = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]), lambda x: x.isNotNull())
    rows = results.select("query_id", F.explode(found).alias("problem"))
    twice = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("query_id", F.lit("query_id repeated").alias("problem"))
    count = results.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != expected)
    count = count.select(F.lit(None).cast(results.schema["query_id"].dataType).alias("query_id"), F.lit("wrong number of records").alias("problem"))
    return rows.unionByName(twice).unionByName(count)

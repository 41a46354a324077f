"""Writers. Files that a job replaces are written to their own folder by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_index(index: DataFrame, path: str) -> None:
    """Vectors and metadata in the same rows, by encoder."""
    index.write.mode("overwrite").partitionBy("encoder").parquet(path)


def write_records(results: DataFrame, path: str) -> None:
    """A JSON record per query. One file: the records of an evaluation are few."""
    results.coalesce(1).write.mode("overwrite").json(path)


def ranking_cache(rankings: DataFrame) -> DataFrame:
    """(query_id, rankings): arrays of (chunk_id, sim to 6 digits) by encoder, without texts."""
    lists = rankings.groupBy("query_id", "encoder").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", F.round("sim", 6).alias("sim")))).alias("_l"))
    slim = F.transform("_l", lambda x: F.struct(x["chunk_id"].alias("chunk_id"), x["sim"].alias("sim")))
    return lists.groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("encoder", slim.alias("l"))))).alias("rankings"))


def entity_cache(found: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, menciones), confidence to 4 digits."""
    m = F.struct("inicio", "fin", "texto", "tipo", F.round("confianza", 4).alias("confianza"))
    return found.groupBy("chunk_id", "doc_id").agg(F.array_sort(F.collect_list(m)).alias("menciones"))


def ground_truth(grades: DataFrame, documents: DataFrame) -> DataFrame:
    """(query_id, fragmentos, documentos) from the two tables of judgments."""
    frags = grades.groupBy("query_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("chunk_id", "grade")))).alias("fragmentos"))
    docs = documents.groupBy("query_id").agg(F.array_sort(F.collect_set("doc_id")).alias("documentos"))
    return frags.join(docs, "query_id", "full")


def queries_with_phenomenon(queries: DataFrame, phenomenon) -> DataFrame:
    return queries.withColumn("fenomeno", phenomenon(F.col("query_id")))


def filled(df: DataFrame) -> DataFrame:
    """Null strings as empty ones."""
    return df.na.fill("")


def aligned(vectors: DataFrame, meta: DataFrame) -> DataFrame:
    """(encoder, vectores, filas, alineado): whether each index has as many vectors as rows of metadata."""
    a = vectors.groupBy("encoder").agg(F.count(F.lit(1)).alias("vectores"))
    b = meta.groupBy("encoder").agg(F.count(F.lit(1)).alias("filas"))
    out = a.join(b, "encoder", "full").na.fill(0, ["vectores", "filas"])
    return out.withColumn("alineado", F.col("vectores") == F.col("filas"))

"""The corpus pipeline: quality, line dedup, near dedup, decontamination, packing. STAGES run one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontamination import leaks
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import default_vocabulary, pack
from tidemark.llm.quality_classifier import accepted_rows
from tidemark.llm.workspace import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return accepted_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the largest document only; a document keeps its place even if no line is left."""
    out = dedup_lines(docs.select("doc_id", "text", F.struct("*").alias("whole")))
    new = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    made = {"text": new, "n_chars": F.length(new).cast(docs.schema["n_chars"].dataType)}
    return out.select(*[made.get(c, F.col("whole")[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, 0.8 and more)."""
    gone = near_duplicates(docs, size=5).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = Workspace(spark, "decontaminate").save(found.select("doc_id").distinct(), "found")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096."""
    return pack(docs, default_vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Models, tokens and packing are not SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = ws.save(docs, name)
    return docs

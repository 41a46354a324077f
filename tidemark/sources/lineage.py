"""Cutting the lineage of tables that loops build on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The table, written to the checkpoint folder that all executors share. Where none is set: a temporary one in local
    mode, else an error."""
    context = df.sparkSession.sparkContext
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir():
        if not folder and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or "file://" + tempfile.mkdtemp(prefix="tidemark-"))
    return df.checkpoint()

"""Take in new files once: each run handles what came since the last one and then stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def take_in(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], target: str, state: str, files_per_batch: int = 1000) -> None:
    """Apply a stage to the Parquet files of `source` that no earlier run has seen, and append its rows to `target`.

    `state` is a folder of the job's own that all executors share. A batch that was interrupted is written again whole:
    each batch overwrites its own partition of the target.
    """

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

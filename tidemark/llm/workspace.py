"""Tables written between the stages of a job, in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where none is named: a new temporary one in local mode, else an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Workspace:
    """A folder for one job. save() cuts the lineage: what was written survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._made = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and return the written table."""
        self._made += 1
        path = f"{self.path}/{self._made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._workspace_path = path
        return out

    def read(self, path: str) -> DataFrame:
        """A table that was saved before."""
        out = self.spark.read.parquet(path)
        out._workspace_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that nothing will read again."""
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._workspace_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        """Delete all tables of the job, once its result is written."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def collect_garbage(self) -> None:
        """Let Spark's cleaner remove shuffle files of finished stages."""
        gc.collect()
        self.spark._jvm.System.gc()


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that other columns can't clash with the operator's own."""
    return df.select(*[df[c] for c in columns])


def with_row_key(df: DataFrame, id_col: str, ws: Workspace) -> DataFrame:
    """Add _row, a number that no two rows share: the id where ids are whole numbers, distinct and not null.

    Else the table is written once with numbers of its own, so that every later pass sees the same ones.
    """
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        counts = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).agg(
            F.max("n"), F.max(F.col(id_col).isNull().cast("int"))
        ).first()
        if counts[0] is None or (counts[0] == 1 and counts[1] == 0):
            return df.withColumn("_row", F.col(id_col).cast("long"))
    return ws.save(df.withColumn("_row", F.monotonically_increasing_id()), "keyed")

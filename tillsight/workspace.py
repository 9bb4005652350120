"""Intermediate tables in the shared folder.

A result that several later steps read is written once as parquet. That cuts its lineage (a lost
executor re-reads files instead of re-scanning the transactions), lets each reader prune columns,
and fixes any row numbering made on the way.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tillsight-")
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


class Workspace:
    """One run's folder below the shared root."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_root(spark)}/run-{uuid.uuid4().hex}"
        self._saved = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def remove(self) -> None:
        """Delete the run's folder; what was saved in it cannot be read any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.delete(path, True)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df once and return a frame that reads it back.

        Names are numbered per workspace, so a second workspace on the same folder overwrites
        the first one's tables in turn.
        """
        self._saved += 1
        path = self.path(f"{self._saved:02d}-{name}")
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

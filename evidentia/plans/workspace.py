"""Written tables in the folder that driver and executors share.

A plan that several later plans read is written once, so that a lost executor costs a read and not a recomputation. Results
read these tables when they run, so whoever owns the folder clears it after the results are stored.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where that is unset, as in tests, a folder of this machine."""
    key = "spark.checkpoint.dir"
    root = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="evidentia-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = f"file://{folder}"
        spark.conf.set(key, root)
    return root.rstrip("/")


class Workspace:
    """Tables of one query under a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Writes df now and returns the written rows."""
        to = f"{self.path}/{name}"
        writer = df.write.mode("overwrite").option("compression", "zstd")
        freed = self.spark.conf.get(_FREED, "false")
        self.spark.conf.set(_FREED, "true")  # once the table stands, nothing reads the shuffles that made it
        try:
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(to)
        finally:
            self.spark.conf.set(_FREED, freed)
        order = [c for c in df.columns if c not in (partition_by or [])] + (partition_by or [])
        schema = T.StructType([df.schema[c] for c in order])
        return self.spark.read.schema(schema).parquet(to)

    def drop(self, name: str) -> None:
        """Deletes a table that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        to = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        to.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)

"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where it is unset and Spark runs in one process, a temporary one.

    Elsewhere executors would each write to their own disk: RuntimeError.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="groundplan-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Tables that are written between two calls of `tidy`.
TIDY = 6


def tidy(spark: SparkSession) -> None:
    """Let go of plans that nobody uses any more, so that Spark's cleaner deletes their shuffle files.

    The cleaner works when the JVM collects garbage, by itself once in half an hour (spark.cleaner.periodicGC.interval). Until then
    an operator of many written tables fills the driver's heap with plans and task records, and disks with shuffle files.
    """
    gc.collect()
    spark._jvm.System.gc()


class Scratch:
    """Tables written once and read back, which cuts lineage without pinning rows to an executor.

    The tables live until `drop` is called or the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.deleteOnExit(path)
        self._saved = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and return it as read from the written table."""
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        self._saved += 1
        if self._saved % TIDY == 0:
            tidy(self.spark)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"), True)

"""Intermediate tables in the folder that driver and executors share.

The folder is the session's ``spark.checkpoint.dir``. Tables written there cut lineage:
after the loss of an executor only reading them is repeated.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that the driver and all executors share")
    base = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set(_SETTING, base)
    return base


class Scratch:
    """One run's own folder of written tables."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """The frame, computed once and read back from the shared folder."""
        where = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(where, compression=codec)
        return self.spark.read.schema(df.schema).parquet(where)

    def keep_only(self, *names: str) -> None:
        """Delete the run's other tables, which no later step reads."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(folder):
            if status.getPath().getName() not in names:
                files.delete(status.getPath(), True)


def sent_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, marked to be sent to all tasks if it has no more rows than that; joined by shuffles otherwise."""
    return F.broadcast(df) if df.count() <= rows else df

"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode a folder of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{tempfile.gettempdir()}/curlew-checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """From now on a session that has no other bound hands Python batches of at most this size, or one row: 10,000 long texts are
    more than a worker should hold."""
    if spark.conf.get(BATCH_BYTES, None) in (None, str(2**31 - 1)):
        spark.conf.set(BATCH_BYTES, size)


class Workspace:
    """Parquet tables that cut lineage and outlive executors; drop() frees those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._curlew_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._curlew_path)
            path.getFileSystem(conf).delete(path, True)

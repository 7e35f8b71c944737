"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job here relies on; cluster size and memory stay the caller's business.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "docsift", **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which all executors can reach.

    Only a local session may fall back to a temporary folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    path = tempfile.mkdtemp(prefix="docsift-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a table's size; for one read from files, what they take on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from files that outlive
    any executor, and Spark knows their true size when it chooses a join."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps that nothing refers to any more. It does so when the driver
    collects its garbage, which may be long in coming while executors fill their disks. Call it between large steps
    whose results are stored.

    Python gives its references up behind the first collection, so the second one finds what they held.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.java.lang.System.gc()
        time.sleep(1)


class Scratch:
    """A folder of tables below the shared folder that one job owns: it drops what it no longer reads."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, scratch_path(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back, as `materialize` does."""
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        """Remove a table of this folder, or all of it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

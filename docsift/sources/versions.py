"""An index as a folder of immutable table versions and a small log of which one is current."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "seq bigint, version string"


class VersionedTable:
    """`<root>/<version>/` holds data, `<root>/_published/` the publication log.

    A reader resolves the newest log row once and then reads files that never change, so it sees
    the old version or the new one and nothing in between.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: tuple[str, ...] = (),
                 sort_by: tuple[str, ...] = ("type", "id")):
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_by, self.sort_by = partition_by, sort_by

    def path(self, version: str) -> str:
        return f"{self.root}/{version}"

    def new_version(self) -> str:
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
        return f"v{stamp}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, version: str | None = None) -> str:
        """Write a version; an existing one is never touched. Rows are rebalanced by the partition
        columns, which splits a tenant that is too large for one task and joins small ones."""
        version = version or self.new_version()
        df = df.hint("rebalance", *self.partition_by) if self.partition_by else df
        order = [c for c in (*self.partition_by, *self.sort_by) if c in df.columns]
        if order:
            df = df.sortWithinPartitions(*order)
        df.write.mode("errorifexists").partitionBy(*self.partition_by).parquet(self.path(version))
        return version

    def _hadoop(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, version: str) -> bool:
        fs, path = self._hadoop(self.path(version))
        return fs.exists(path)

    def publications(self) -> DataFrame:
        if not self.exists("_published"):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/_published/")

    def current(self) -> str | None:
        row = self.publications().orderBy(F.desc("seq"), F.desc("version")).first()
        return None if row is None else row["version"]

    def publish(self, version: str, drop_previous: bool = False) -> None:
        """Make a version current by appending one row to the log."""
        before = self.publications().orderBy(F.desc("seq"), F.desc("version")).first()
        seq = 1 if before is None else before["seq"] + 1
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(seq).cast("bigint").alias("seq"), F.lit(version).alias("version"))
        row.write.mode("append").json(f"{self.root}/_published")
        if drop_previous and before is not None and before["version"] != version:
            self.drop(before["version"])

    def drop(self, version: str) -> None:
        fs, path = self._hadoop(self.path(version))
        fs.delete(path, True)

    def read(self, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise ValueError(f"nothing is published in {self.root}")
        return self.spark.read.parquet(self.path(version))

    def replace_with(self, change: Callable[[DataFrame], DataFrame],
                     drop_previous: bool = False) -> DataFrame:
        """Next version = `change(current version)`, published."""
        version = self.write(change(self.read()))
        self.publish(version, drop_previous)
        return self.read(version)

"""Reading source tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docsift.session import stored_bytes

# Tables of up to so many bytes per core are dealt out to all cores: such a shuffle is nothing.
SPREAD_BYTES = 16 * 1024 * 1024


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table, in the splits of its scan. `spread` is for row-wise heavy work (text analysis) on a
    small table, whose few row groups would keep most cores idle: it is dealt out. A larger table is
    read as it lies, whatever its number of files.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and stored_bytes(df) < cores * SPREAD_BYTES else df


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a given schema, so that no pass over the data is spent on guessing one."""
    return spark.read.schema(schema).json(path)

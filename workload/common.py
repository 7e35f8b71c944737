"""Registration, and the driver tables seen as documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.schema import DEFAULT_MAPPING
from docsift.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MAPPING = DEFAULT_MAPPING.plus("brand", "status", "priority")

# the word pattern inside a SQL string
RX = r"[\p{L}\p{N}_]+(?:[.''’][\p{L}\p{N}_]+)*"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{RX}')"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", spread)


def parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("type"), F.col("p_name").alias("name"),
        F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
        F.concat(F.split("p_name", " "), F.array(F.lower("p_type"))).alias("tags"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("order").alias("type"),
        F.col("o_custkey").alias("creatorid"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("timestamp"))


def events(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    return table(spark, sf, "events", spread).select(
        F.concat(F.lit("u"), (F.col("user_id") % 8).cast("string")).alias("appid"),
        F.col("event_id").alias("id"), F.col("event_type").alias("type"),
        F.col("user_id").alias("creatorid"), F.col("ts").alias("timestamp"), "value",
        F.col("props").alias("properties"))


EVENTS_SQL = """SELECT 'u' || CAST(user_id % 8 AS VARCHAR) AS appid, event_id AS id,
 event_type AS type, user_id AS creatorid, ts AS "timestamp", value, props FROM events"""

# an order whose dynamic properties hold an object, an array of values and an array of objects
ORDER_PROPERTIES = """to_json(named_struct(
 'status', o_orderstatus, 'total', o_totalprice,
 'customer', named_struct('id', o_custkey, 'band', concat('band ', cast(o_custkey % 7 as string))),
 'marks', array(o_orderstatus, o_orderpriority),
 'steps', array(named_struct('code', o_orderstatus, 'year', year(o_orderdate)),
                named_struct('code', o_orderpriority, 'year', year(o_orderdate) + 1))))"""


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders", spread=True).select(
        F.col("o_orderkey").alias("id"), F.lit("a").alias("appid"), F.lit("order").alias("type"),
        F.col("o_orderdate").alias("timestamp"), F.expr(ORDER_PROPERTIES).alias("properties"))

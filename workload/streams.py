"""Continuous indexing: the events table read as a file stream until it is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators import maintain
from docsift.session import scratch_path
from docsift.sources.buckets import BucketedIndex
from docsift.streaming import ingest
from docsift.streaming.compact import DELETE_TERMS, LoggedIndex, follow
from workload.common import query, table
from workload.maintenance import OPS_SQL

KEYS = ["id"]


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return _user_ops(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


def _user_ops(rows):
    return rows.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"),
        F.col("event_type").alias("type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "signup", F.lit(maintain.DELETE))
        .otherwise(F.lit(maintain.PUT)).alias("op"))


def _run(spark, start, rows):
    home = scratch_path(spark, "stream")
    start(rows, f"{home}/log", f"{home}/checkpoint").awaitTermination()
    return f"{home}/log"


@query("stream_upsert", f"""{OPS_SQL} SELECT id, type, value FROM fresh
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""")
def stream_upsert(spark, sf):
    log = _run(spark, ingest.bulk_ingest, _stream(spark, sf))
    return ingest.live_index(None, ingest.logged_ops(spark, log), "replace", KEYS)


@query("stream_merge", f"""{OPS_SQL} SELECT id, arg_max(type, seq) AS type,
 arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM fresh GROUP BY id""")
def stream_merge(spark, sf):
    log = _run(spark, ingest.bulk_ingest, _stream(spark, sf))
    return ingest.live_index(None, ingest.logged_ops(spark, log), "merge", KEYS)


@query("stream_latest", """SELECT user_id AS id, event_id AS seq, event_type AS type,
 CASE WHEN value >= 10 THEN value END AS value FROM events
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def stream_latest(spark, sf):
    log = _run(spark, lambda rows, *where: ingest.latest_state(rows, *where, keys=KEYS),
               _stream(spark, sf).drop("op"))
    return ingest.changed_state(spark, log, KEYS)


def _tenant_ops(rows):
    return rows.withColumns({"appid": F.concat(F.lit("u"), (F.col("id") % 8).cast("string")),
                             "id": F.col("id").cast("string")})


class _Feed:
    """A log that parts of the events are streamed into, and the index that it feeds."""

    def __init__(self, spark, sf):
        self.spark, self.sf, self.home = spark, sf, scratch_path(spark, "feed")
        self.logged = LoggedIndex(BucketedIndex(spark, f"{self.home}/index", bucket_rows=200), f"{self.home}/log")
        self.first = 0

    def stream(self, rows):
        """One query after the other writes to the same log; the batches of each are numbered behind those before it."""
        home = scratch_path(self.spark, "stream")
        ingest.bulk_ingest(rows, f"{home}/log", f"{home}/checkpoint").awaitTermination()
        ops = ingest.logged_ops(self.spark, f"{home}/log")
        ops.write.parquet(f"{self.home}/log/batch={self.first}")
        self.first += 1


STATE_SQL = f"""{OPS_SQL} SELECT 'u' || CAST(id % 8 AS VARCHAR) AS appid, CAST(id AS VARCHAR) AS id, type, value FROM fresh
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1"""


@query("stream_compact", STATE_SQL)
def stream_compact(spark, sf):
    """A log compacted into the published index, which alone is read."""
    feed = _Feed(spark, sf)
    feed.stream(_tenant_ops(_stream(spark, sf)))
    feed.logged.compact()
    return feed.logged.read().select("appid", "id", "type", "value")


@query("stream_onto_base", STATE_SQL)
def stream_onto_base(spark, sf):
    """Half of the operations is published, half is still in the log; both halves hold operations that come late."""
    feed = _Feed(spark, sf)
    feed.stream(_tenant_ops(_stream(spark, sf)).filter("seq % 2 = 1"))
    feed.logged.compact()
    feed.stream(_tenant_ops(_stream(spark, sf)).filter("seq % 2 = 0"))
    return feed.logged.read().select("appid", "id", "type", "value")


@query("stream_delete_terms", """WITH ops AS (SELECT user_id AS id, event_id AS seq, event_type AS type, value,
  value > 60 AND event_id % 2 = 0 AS marks FROM events),
 state AS (SELECT * FROM ops WHERE NOT marks QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1)
 SELECT 'u' || CAST(id % 8 AS VARCHAR) AS appid, CAST(id AS VARCHAR) AS id, type, value FROM state
 WHERE NOT EXISTS (SELECT 1 FROM ops WHERE ops.marks AND ops.seq > state.seq AND ops.type = state.type AND state.value < 25)""")
def stream_delete_terms(spark, sf):
    """Some events delete all documents of their type with a small value, as of their own time; some of them are
    compacted, some still in the log, and puts come late on either side."""
    rows = (spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf))
    marks = (F.col("value") > 60) & (F.col("event_id") % 2 == 0)
    terms = F.to_json(F.struct(F.col("event_type").alias("type"), F.lit(25).alias("value <")))
    ops = _tenant_ops(rows.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("event_type").alias("type"), "value",
        F.when(marks, DELETE_TERMS).otherwise(maintain.PUT).alias("op"), F.when(marks, terms).alias("terms")))
    feed = _Feed(spark, sf)
    for part in range(3):
        feed.stream(ops.filter(F.col("seq") % 3 == part))
        if part < 2:
            feed.logged.compact()
    return feed.logged.read().select("appid", "id", "type", "value")


@query("stream_follow", STATE_SQL)
def stream_follow(spark, sf):
    """The stream is followed in many micro-batches and compacted on the way; what is left in the log is read on top."""
    home = scratch_path(spark, "follow")
    events = table(spark, sf, "events")
    events.repartition(6, F.col("event_id") % 6).write.parquet(f"{home}/events")
    rows = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/events"))
    logged = LoggedIndex(BucketedIndex(spark, f"{home}/index", bucket_rows=1000), f"{home}/log")
    follow(_tenant_ops(_user_ops(rows)), logged, f"{home}/checkpoint", every=2).awaitTermination()
    return logged.read().select("appid", "id", "type", "value")

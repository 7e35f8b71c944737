"""Upserts, deletes, rebuilds and checks against the system of record."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docsift.operators import find, hydrate, maintain
from docsift.operators.rebuild import rebuild_index
from docsift.plans.paging import Page, take_page
from docsift.session import scratch_path
from docsift.sources.buckets import BucketedIndex
from docsift.sources.versions import VersionedTable
from workload.common import EVENTS_SQL, MAPPING, events, orders, query, table

KEYS = ["id"]
CUT = "2024-01-15 00:00:00"


def _user_ops(spark, sf):
    """Every event writes the document of its user; low values are left out of the write."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"),
        F.col("event_type").alias("type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") == "signup", F.lit(maintain.DELETE))
        .otherwise(F.lit(maintain.PUT)).alias("op"))


WRITES_SQL = """SELECT user_id AS id, event_id AS seq, ts AS at, event_type AS type,
 CASE WHEN value >= 10 THEN value END AS value FROM events"""


def _halves(spark, sf, mode):
    writes = _user_ops(spark, sf).drop("op")
    early = maintain.resolve_ops(writes.filter(F.col("at") < F.lit(CUT).cast("timestamp_ntz"))
                                 .withColumn("op", F.lit(maintain.PUT)).drop("at"), mode, KEYS)
    late = writes.filter(F.col("at") >= F.lit(CUT).cast("timestamp_ntz")).drop("at")
    return early, late


@query("upsert_merge", f"""SELECT id, arg_max(type, seq) AS type,
 arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM ({WRITES_SQL}) GROUP BY id""")
def upsert_merge(spark, sf):
    early, late = _halves(spark, sf, "merge")
    return maintain.upsert(early, late, "merge", KEYS)


@query("upsert_replace", f"""SELECT id, type, value FROM ({WRITES_SQL})
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""")
def upsert_replace(spark, sf):
    early, late = _halves(spark, sf, "replace")
    return maintain.upsert(early, late, "replace", KEYS)


@query("upsert_merge_large", f"""SELECT id, arg_max(type, seq) AS type,
 arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM ({WRITES_SQL}) GROUP BY id""")
def upsert_merge_large(spark, sf):
    """The way taken when a batch has too many keys to broadcast."""
    early, late = _halves(spark, sf, "merge")
    return maintain.upsert(early, late, "merge", KEYS, broadcast_bytes=0)


OPS_SQL = """WITH ops AS (SELECT user_id AS id, event_id AS seq, event_type AS type,
  CASE WHEN value >= 10 THEN value END AS value, event_type = 'signup' AS gone FROM events),
 cut AS (SELECT id, max(seq) FILTER (WHERE gone) AS d FROM ops GROUP BY id),
 fresh AS (SELECT ops.* FROM ops JOIN cut USING (id) WHERE NOT gone AND seq > coalesce(d, -1))"""


@query("resolve_merge", f"""{OPS_SQL} SELECT id, arg_max(type, seq) AS type,
 arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM fresh GROUP BY id""")
def resolve_merge(spark, sf):
    return maintain.resolve_ops(_user_ops(spark, sf).drop("at"), "merge", KEYS)


@query("resolve_replace", f"""{OPS_SQL} SELECT id, type, value FROM fresh
 QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1""")
def resolve_replace(spark, sf):
    return maintain.resolve_ops(_user_ops(spark, sf).drop("at"), "replace", KEYS)


@query("unindex_ids", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def unindex_ids(spark, sf):
    gone = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id"))
    return maintain.unindex(orders(spark, sf), gone, KEYS).select("id", "total")


@query("delete_by_terms", f"""SELECT id, value FROM ({EVENTS_SQL})
 WHERE NOT (type = 'error' AND value < 50)""")
def delete_by_terms(spark, sf):
    return maintain.unindex_terms(events(spark, sf), {"type": "error", "value <": 50}).select(
        "id", "value")


@query("delete_by_any_term", f"""SELECT id, value FROM ({EVENTS_SQL})
 WHERE NOT (type = 'error' OR value < 50)""")
def delete_by_any_term(spark, sf):
    return maintain.unindex_terms(events(spark, sf), {"type": "error", "value <": 50},
                                  match_all=False).select("id", "value")


@query("delete_everything", "SELECT event_id AS id, value FROM events WHERE false")
def delete_everything(spark, sf):
    return maintain.unindex_terms(events(spark, sf), None, allow_all=True).select("id", "value")


@query("drop_tenant", f"SELECT appid, type, count(*) AS n FROM ({EVENTS_SQL}) "
                      "WHERE appid <> 'u3' GROUP BY ALL")
def drop_tenant(spark, sf):
    left = maintain.drop_tenant(events(spark, sf), "u3")
    return left.groupBy("appid", "type").agg(F.count(F.lit(1)).alias("n"))


@query("rebuild_index", "SELECT count(*) AS reindexed FROM events")
def rebuild(spark, sf):
    index = VersionedTable(spark, scratch_path(spark, "index"), ("appid",))
    return rebuild_index(events(spark, sf, spread=True), index)


@query("rebuild_into_existing", f"""SELECT appid, count(*) AS n, sum(CASE WHEN value >= 40 THEN 1 ELSE 0 END) AS fresh
 FROM ({EVENTS_SQL}) GROUP BY appid""")
def rebuild_into_existing(spark, sf):
    """A second build into a version that exists: its documents stay beside the new ones, which replace theirs."""
    index = VersionedTable(spark, scratch_path(spark, "index"), ("appid",))
    every = events(spark, sf, spread=True)
    rebuild_index(every.withColumn("run", F.lit(1)), index, "all")
    rebuild_index(every.filter("value >= 40").withColumn("run", F.lit(2)), index, "all")
    return index.read().groupBy("appid").agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.when(F.col("run") == 2, 1).otherwise(0)).alias("fresh"))


@query("rebuild_and_search", f"""SELECT id, type, value FROM ({EVENTS_SQL})
 WHERE appid = 'u5' AND CAST(json_extract(props, '$.k') AS BIGINT) >= 50""")
def rebuild_and_search(spark, sf):
    """Build, publish, change the current version, and search what is published then."""
    index = VersionedTable(spark, scratch_path(spark, "index"), ("appid",))
    rebuild_index(events(spark, sf, spread=True), index)
    index.replace_with(lambda docs: maintain.drop_tenant(docs, "u3"))
    docs = find.scope(index.read(), "u5")
    return find.find_terms(docs, None, {"properties.k >=": 50}).select("id", "type", "value")


def _bucketed(spark, docs):
    """A published index with a few buckets for each tenant."""
    index = BucketedIndex(spark, scratch_path(spark, "buckets"), bucket_rows=max(1, docs.count() // 16))
    index.rebuild(docs)
    return index


USERS_SQL = "SELECT 'u' || CAST(id % 8 AS VARCHAR) AS appid, CAST(id AS VARCHAR) AS id, type, value FROM "


def _by_tenant(users):
    return users.withColumns({"appid": F.concat(F.lit("u"), (F.col("id") % 8).cast("string")),
                              "id": F.col("id").cast("string")})


@query("index_upsert", f"""{USERS_SQL} (SELECT id, arg_max(type, seq) AS type,
 arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value FROM ({WRITES_SQL}) GROUP BY id)""")
def index_upsert(spark, sf):
    """Upsert, publish, read: two batches on top of a published index."""
    early, late = _halves(spark, sf, "merge")
    index = _bucketed(spark, _by_tenant(early))
    late = _by_tenant(late)
    middle = late.agg(F.percentile_approx("seq", 0.5)).first()[0]
    index.upsert(late.filter(F.col("seq") <= middle))
    index.upsert(late.filter(F.col("seq") > middle))
    return index.read().select("appid", "id", "type", "value")


@query("index_delete", f"""SELECT appid, CAST(id AS VARCHAR) AS id, value FROM ({EVENTS_SQL})
 WHERE NOT (type = 'error' AND value < 50) AND appid <> 'u3'
 AND id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def index_delete(spark, sf):
    """Deletion by terms, by ids and of a tenant, each published, then read."""
    docs = events(spark, sf, spread=True).select("appid", F.col("id").cast("string").alias("id"), "type", "value")
    index = _bucketed(spark, docs)
    index.delete_terms({"type": "error", "value <": 50})
    index.drop_tenant("u3")
    ids = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("id"))
    index.delete_ids(ids.distinct().select("id", F.explode(F.array(*[F.lit(f"u{n}") for n in range(8)])).alias("appid")))
    return index.read().select("appid", "id", "value")


@query("index_count", f"SELECT appid, count(*) AS n FROM ({EVENTS_SQL}) WHERE type <> 'view' GROUP BY appid")
def index_count(spark, sf):
    """Documents by tenant after a deletion, from the manifest alone."""
    docs = events(spark, sf, spread=True).select("appid", F.col("id").cast("string").alias("id"), "type")
    index = _bucketed(spark, docs)
    index.delete_terms({"type": "view"})
    folders = index.folders(index.current())
    rows = spark.createDataFrame([(a, f.rows) for (a, _), f in folders.items()], "appid string, rows bigint")
    return rows.groupBy("appid").agg(F.sum("rows").alias("n"))


@query("index_count_types", f"""SELECT appid, type, count(*) AS n FROM ({EVENTS_SQL})
 WHERE NOT (type = 'error' AND value < 50) AND appid IN ('u1', 'u2') GROUP BY ALL""")
def index_count_types(spark, sf):
    """Documents by type after a deletion, from the statistics that the index keeps up with each change."""
    docs = events(spark, sf, spread=True).select("appid", F.col("id").cast("string").alias("id"), "type", "value")
    index = BucketedIndex(spark, scratch_path(spark, "buckets"), bucket_rows=max(1, docs.count() // 16), counted=("type",))
    index.rebuild(docs)
    index.delete_terms({"type": "error", "value <": 50})
    by_tenant = [index.counts_by_type(appid=a).select(F.lit(a).alias("appid"), "type", "n") for a in ("u1", "u2")]
    return by_tenant[0].unionByName(by_tenant[1])


@query("bulk_report", """SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM (
 SELECT CASE WHEN value < 1 THEN 'missing id'
  WHEN event_type = 'error' AND value > 50 THEN 'bad date in timestamp'
  WHEN value > 40 THEN 'bad properties' END AS reason FROM events) GROUP BY ALL""")
def bulk_report(spark, sf):
    batch = table(spark, sf, "events").select(
        F.when(F.col("value") >= 1, F.col("event_id").cast("string")).alias("id"),
        F.lit("a").alias("appid"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.lit("soon"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("timestamp"),
        F.when(F.col("value") > 40, F.substring("props", 1, 4)).otherwise(F.col("props"))
        .alias("properties"))
    accepted, rejected = maintain.split_batch(batch)
    outcomes = accepted.select(F.lit("accepted").alias("outcome")).unionByName(
        rejected.select(F.col("reason").alias("outcome")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _records(spark, sf):
    """The system of record: pending orders have been deleted from it, prices have moved on."""
    return orders(spark, sf).filter("status <> 'P'").withColumn("total", F.col("total") + 1)


@query("hydrate_hits", """SELECT o_orderkey AS id, o_orderstatus AS status,
 round(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 ELSE o_totalprice END, 6) AS total
 FROM orders WHERE o_orderpriority = '1-URGENT'""")
def hydrate_hits(spark, sf):
    hits = find.find_terms(orders(spark, sf), "order", {"priority": "1-URGENT"}, True, MAPPING)
    full = hydrate.hydrate(hits, _records(spark, sf), KEYS)
    return full.select("id", "status", F.round("total", 6).alias("total"))


@query("hydrate_page", """SELECT CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rank,
 o_orderkey AS id, o_orderstatus AS status,
 round(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 ELSE o_totalprice END, 6) AS total
 FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def hydrate_page(spark, sf):
    """A ranked page of hits, completed from the records and in the order of the hits."""
    hits = find.find_terms(orders(spark, sf), "order", {"priority": "1-URGENT"}, True, MAPPING)
    page = take_page(hits, Page(limit=50, sort="total"))
    page = page.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "id")))
    full = hydrate.hydrate(page, _records(spark, sf), KEYS)
    return full.orderBy("rank").select("rank", "id", "status", F.round("total", 6).alias("total"))


@query("hydrate_raw", """SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total
 FROM orders WHERE o_orderpriority = '1-URGENT'""")
def hydrate_raw(spark, sf):
    """The hits as the index has them; the system of record isn't read."""
    hits = find.find_terms(orders(spark, sf), "order", {"priority": "1-URGENT"}, True, MAPPING)
    return hydrate.hydrate(hits, _records(spark, sf), KEYS, read_from_index=True).select("id", "status", "total")


@query("orphan_report", """SELECT o_orderkey AS id FROM orders
 WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'""")
def orphan_report(spark, sf):
    hits = find.find_terms(orders(spark, sf), "order", {"priority": "1-URGENT"}, True, MAPPING)
    return hydrate.orphans(hits.withColumn("stored", F.lit(True)), _records(spark, sf), KEYS).select("id")


@query("clean_orphans", "SELECT o_orderkey AS id, o_totalprice AS total FROM orders WHERE o_orderstatus <> 'P'")
def clean_orphans(spark, sf):
    return hydrate.clean_orphans(orders(spark, sf), _records(spark, sf), KEYS).select("id", "total")

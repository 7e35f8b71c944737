"""Upserts, operation logs, deletes, reports, hydration, versions and rebuilds."""

import random

import pytest
from conftest import ids
from pyspark.sql import functions as F

from docsift.operators import hydrate, maintain
from docsift.operators.rebuild import rebuild_index
from docsift.session import scratch_path
from docsift.sources.tables import read_documents, read_table
from docsift.sources.versions import VersionedTable

OPS = "appid string, id string, seq long, op string, x string, y long, tags array<string>, s struct<a: long, b: long>"


def put(id, seq, x=None, y=None, tags=None, s=None, appid="a"):
    return (appid, id, seq, "put", x, y, tags, s)


def gone(id, seq):
    return ("a", id, seq, "delete", None, None, None, None)


def state(df):
    return {r["id"]: (r["x"], r["y"], r["tags"], r["s"] and tuple(r["s"])) for r in df.collect()}


def apply(log, mode):
    """The same log, one operation after another."""
    docs = {}
    for appid, id, _, op, *values in sorted(log, key=lambda r: r[2]):
        if op == "delete":
            docs.pop(id, None)
        elif mode == "replace" or id not in docs:
            docs[id] = list(values)
        else:
            old = docs[id]
            for n, v in enumerate(values):
                if n == 3 and v is not None and old[n] is not None:
                    old[n] = tuple(o if w is None else w for o, w in zip(old[n], v))
                elif v is not None:
                    old[n] = v
    return {k: tuple(v) for k, v in docs.items()}


def random_log(seed, size=400):
    rng, log = random.Random(seed), []
    for seq in range(size):
        id = f"k{min(rng.randint(0, 30), rng.randint(0, 30))}"
        if rng.random() < 0.15:
            log.append(gone(id, seq))
        else:
            maybe = lambda v: v if rng.random() < 0.5 else None
            log.append(put(id, seq, maybe(f"x{seq}"), maybe(seq), maybe([str(seq)]),
                           maybe((maybe(seq), seq + 1))))
    rng.shuffle(log)
    return log


@pytest.mark.parametrize("mode", ["merge", "replace"])
@pytest.mark.parametrize("seed", [1, 2])
def test_log_in_any_order(spark, mode, seed):
    log = random_log(seed)
    got = state(maintain.resolve_ops(spark.createDataFrame(log, OPS), mode))
    assert got == apply(log, mode)


@pytest.mark.parametrize("mode", ["merge", "replace"])
@pytest.mark.parametrize("most", [maintain.BROADCAST_BYTES, 0])
def test_upsert_equals_log(spark, mode, most):
    log = random_log(3)
    early = [r for r in log if r[2] < 200]
    late = [r for r in log if r[2] >= 200]
    snapshot = maintain.resolve_ops(spark.createDataFrame(early, OPS), mode)
    batch = spark.createDataFrame(late, OPS)
    got = state(maintain.upsert(snapshot, batch, mode, op="op", broadcast_bytes=most))
    assert got == apply(log, mode)


def test_second_write_wins(spark):
    log = [put("1", 1, "v1", 1), put("1", 2, "v2")]
    df = spark.createDataFrame(log, OPS)
    assert state(maintain.resolve_ops(df, "replace"))["1"][:2] == ("v2", None)
    assert state(maintain.resolve_ops(df, "merge"))["1"][:2] == ("v2", 1)
    with pytest.raises(ValueError):
        maintain.resolve_ops(df, "both")


def test_batch_with_fewer_fields(spark):
    snapshot = spark.createDataFrame([("a", "1", "x", 1)], "appid string, id string, x string, y long")
    batch = spark.createDataFrame([("a", "1", 5, "z")], "appid string, id string, seq long, x string")
    row = maintain.upsert(snapshot, batch, "merge").first()
    assert (row["x"], row["y"]) == ("z", 1)


def test_merge_then_unindex_leaves_nothing(spark):
    docs = maintain.resolve_ops(spark.createDataFrame([put("1", 1, "x"), put("2", 2, "y")], OPS))
    keys = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", None), ("a", "9"), ("b", "2")],
                                 "appid string, id string")
    left = maintain.unindex(docs, keys)
    assert ids(left) == ["2"]
    assert maintain.unindex(left, docs).count() == 0


def test_delete_by_terms(spark):
    docs = spark.createDataFrame([("1", "xx", 123), ("2", "xx", 123), ("3", "sps3", 1234), ("4", None, None)],
                                 "id string, name string, n long")
    assert ids(maintain.unindex_terms(docs, {"name": "xx", "n": 123})) == ["3", "4"]
    assert ids(maintain.unindex_terms(docs, {"name": "xx", "n": 1234}, match_all=False)) == ["4"]
    assert ids(maintain.unindex_terms(docs, {"name": " "})) == ["1", "2", "3", "4"]
    assert maintain.unindex_terms(docs, {}, allow_all=True).count() == 0
    with pytest.raises(ValueError):
        maintain.unindex_terms(docs, None)


def test_tenants(spark):
    docs = spark.createDataFrame([("t1", "myapp1"), ("t2", " myapp2"), ("t3", "myapp1")],
                                 "id string, appid string")
    assert ids(maintain.drop_tenant(docs, "myapp1")) == ["t2"]
    assert ids(maintain.drop_tenant(docs, "myapp2")) == ["t1", "t2", "t3"]


def test_report(spark):
    batch = spark.createDataFrame(
        [("1", "a", "2024-01-01", "{}"), (" ", "a", None, None), ("3", None, None, None),
         ("4", "a", "soon", None), ("5", "a", None, "{"), ("6", "a", None, None)],
        "id string, appid string, timestamp string, properties string")
    accepted, rejected = maintain.split_batch(batch)
    assert ids(accepted) == ["1", "6"] and "reason" not in accepted.columns
    assert {r["reason"] for r in rejected.collect()} == {
        "missing id", "missing appid", "bad date in timestamp", "bad properties"}
    with pytest.raises(ValueError):
        maintain.split_batch(batch, on_error="raise")
    maintain.split_batch(accepted, on_error="raise")


def test_hydrate(spark):
    hits = spark.createDataFrame([("a", "1", "old", 2.0, True), ("a", "2", "only", 1.0, True),
                                  ("a", "3", "x", 0.5, False)],
                                 "appid string, id string, name string, score double, stored boolean")
    db = spark.createDataFrame([("a", "1", None, 7), ("b", "2", "other", 8)],
                               "appid string, id string, name string, votes int")
    got = {r["id"]: (r["name"], r["score"], r["votes"]) for r in hydrate.hydrate(hits, db).collect()}
    assert got == {"1": (None, 2.0, 7), "2": ("only", 1.0, None), "3": ("x", 0.5, None)}
    assert hydrate.hydrate(hits, db, read_from_index=True) is hits
    assert ids(hydrate.orphans(hits, db)) == ["2"]
    assert ids(hydrate.clean_orphans(hits, db)) == ["1", "3"]


def test_versions(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"), ("appid",))
    assert table.current() is None
    with pytest.raises(ValueError):
        table.read()
    docs = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", " b")], "id string, appid string")
    first = table.write(docs)
    table.publish(first)
    reader = table.read()
    assert ids(reader) == ["1", "2", "3"]
    assert ids(table.read().filter("appid = ' b'")) == ["3"]
    second = table.replace_with(lambda d: maintain.drop_tenant(d, "b"))
    assert ids(second) == ["1", "3"] and ids(table.read()) == ["1", "3"]
    assert ids(reader) == ["1", "2", "3"]
    assert table.current() != first and table.publications().count() == 2
    third = table.write(table.read().filter("id = '1'"))
    before = table.current()
    table.publish(third, drop_previous=True)
    assert ids(table.read()) == ["1"]
    with pytest.raises(Exception):
        table.read(before).count()
    with pytest.raises(Exception):
        table.write(docs, third)


def test_rebuild(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    db = spark.createDataFrame([("1", "a", '{"x":1}'), ("2", "a", None)],
                               "id string, appid string, properties string")
    assert rebuild_index(db, table).first()["reindexed"] == 2
    old = table.current()
    assert rebuild_index(db.filter("id = '1'"), table, "named", drop_previous=True).first()[0] == 1
    assert table.current() == "named" != old
    assert ids(table.read()) == ["1"]
    assert table.read().first()["properties"][0]["k"] == "x"


def test_rebuild_into_an_existing_version(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"), ("appid",))
    columns = "id string, appid string, name string"
    rebuild_index(spark.createDataFrame([("1", "a", "old"), ("2", "a", "kept")], columns), table, "v1")
    db = spark.createDataFrame([("1", "a", "new"), ("3", "a", "added")], columns)
    assert rebuild_index(db, table, "v1").first()["reindexed"] == 2
    assert {r["id"]: r["name"] for r in table.read().collect()} == {
        "1": "new", "2": "kept", "3": "added"}
    assert ids(table.read("v1")) == ["1", "2"]


def test_reading(spark):
    path = scratch_path(spark, "json")
    spark.createDataFrame([("1", "x")], "id string, name string").write.json(path)
    docs = read_documents(spark, path, "id string, name string, note string").collect()
    assert [(d["id"], d["name"], d["note"]) for d in docs] == [("1", "x", None)]
    table = scratch_path(spark, "parquet")
    spark.range(10).coalesce(1).write.parquet(table)
    assert read_table(spark, table).count() == read_table(spark, table, spread=True).count() == 10


def test_partition_is_pruned(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"), ("appid",))
    table.publish(table.write(spark.range(20).selectExpr(
        "string(id) AS id", "'t' || id % 4 AS appid", "'x' AS type")))
    hits = table.read().filter(F.col("appid") == "t1").filter(F.col("type") == "x")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(appid" in plan and "EqualTo(type,x)" in plan
    assert hits.count() == 5


def test_equal_buckets_are_not_joined(spark):
    columns = "appid string, id string, name string, stored boolean"
    rows = [("a", f"{i}", "x", True) for i in range(300)] + [(None, "n", "x", True), (None, "m", "x", False)]
    docs = spark.createDataFrame(rows, columns)
    db = docs.filter("appid IS NOT NULL").select("appid", "id")
    assert hydrate.differing_buckets(docs.filter("appid IS NOT NULL"), db) == []
    assert hydrate.clean_orphans(docs.filter("appid IS NOT NULL"), db).count() == 300
    assert "Join" not in hydrate.clean_orphans(docs.filter("appid IS NOT NULL"), db)._jdf.queryExecution().executedPlan().toString()
    some = db.filter("id NOT IN ('7', '70')")
    odd = hydrate.differing_buckets(docs, some)
    assert len(odd) == 3 and odd[0] == -1
    left = hydrate.clean_orphans(docs, some)
    assert left.count() == 299 and left.filter("id IN ('7', '70', 'n')").count() == 0 and left.filter("id = 'm'").count() == 1
    # a record that stands twice makes its bucket differ, and costs nothing else
    twice = db.unionByName(db.filter("id = '5'"))
    assert len(hydrate.differing_buckets(docs.filter("appid = 'a'"), twice)) == 1
    assert hydrate.clean_orphans(docs.filter("appid = 'a'"), twice).count() == 300
    assert hydrate.clean_orphans(docs, db.limit(0)).filter("stored").count() == 0

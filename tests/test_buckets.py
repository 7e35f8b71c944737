"""The bucketed index: what a change writes, and what two publishers do to each other."""

import random

import pytest
from conftest import ids
from pyspark.sql import functions as F
from test_maintain import OPS, apply, random_log, state

from docsift.operators import relevance
from docsift.session import scratch_path
from docsift.sources import buckets
from docsift.sources.buckets import BucketedIndex, Conflict

DOCS = "appid string, id string, type string, n long"


@pytest.fixture
def index(spark):
    return BucketedIndex(spark, scratch_path(spark, "buckets"), bucket_rows=10)


def some_docs(spark, tenants=("t1", "t2"), n=40):
    return spark.createDataFrame([(t, f"{t}-{i}", "a" if i % 2 else "b", i) for t in tenants for i in range(n)], DOCS)


def rows(df):
    return sorted(map(tuple, df.select("appid", "id", "type", "n").collect()))


def paths(index, version=None):
    return {p: f.path for p, f in index.folders(version or index.current()).items()}


def test_rebuild_and_read(spark, index):
    assert index.current() is None
    with pytest.raises(ValueError):
        index.read()
    docs = some_docs(spark).unionByName(spark.createDataFrame(
        [(None, "x", "a", 1), (" ", "x", "a", 1), ("t1", None, "a", 1), ("t1", " ", "a", 1)], DOCS))
    index.rebuild(docs)
    assert rows(index.read()) == rows(some_docs(spark))
    assert index.count() == 80 and index.count(appid="t2") == 40
    assert rows(index.read(appid="t2")) == [r for r in rows(some_docs(spark)) if r[0] == "t2"]
    assert {f.buckets for f in index.folders(index.current()).values()} == {4}
    assert all("appid=t2" in f for f in index.read(appid="t2").inputFiles())
    index.rebuild(docs.limit(0))
    assert index.count() == 0 and rows(index.read()) == [] and rows(index.read(appid="t1")) == []


@pytest.mark.parametrize("mode", ["merge", "replace"])
def test_upsert_equals_log(spark, index, mode):
    log = random_log(3)
    schema = spark.createDataFrame([], OPS).drop("seq", "op")
    index.rebuild(schema)
    for low in range(0, 400, 100):
        index.upsert(spark.createDataFrame([r for r in log if low <= r[2] < low + 100], OPS), mode, op="op")
    assert state(index.read()) == apply(log, mode)
    assert index.current().seq == 5


def test_untouched_folders_stay(spark, index):
    index.rebuild(some_docs(spark))
    before = paths(index)
    index.upsert(spark.createDataFrame([("t1", "t1-7", "z", 700, 1)], DOCS + ", seq long"), "replace")
    after = paths(index)
    assert len(before) == 8 and sum(before[p] != after[p] for p in before) == 1
    assert ("t1", "t1-7", "z", 700) in rows(index.read()) and index.count() == 80
    index.delete_ids(spark.createDataFrame([("t2", "t2-3"), ("t2", "t2-3"), ("t2", "unknown"), ("t9", "t1-1"), (None, None)],
                                           "appid string, id string"))
    last = paths(index)
    assert sum(after[p] != last[p] for p in after) == 1 and index.count() == 79
    index.delete_terms({"n": 12, "appid": "t1"})
    assert sum(last[p] != paths(index).get(p) for p in last) == 1 and index.count() == 78
    seq = index.current().seq
    index.delete_terms({"n": 12345})
    index.delete_terms({"n": " "})
    index.delete_ids(spark.createDataFrame([("t2", "unknown")], "appid string, id string"))
    assert index.current().seq == seq


def test_a_bucket_may_become_empty(spark, index):
    index.rebuild(some_docs(spark, ("t1",), 3))
    index.delete_terms({"n >=": 0})
    assert rows(index.read()) == [] and index.folders(index.current()) == {}
    index.upsert(spark.createDataFrame([("t1", "new", "a", 1, 1)], DOCS + ", seq long"))
    assert ids(index.read()) == ["new"]


def test_dropped_tenant_costs_nothing(spark, index):
    index.rebuild(some_docs(spark, ("t1", " t2", "a=b/c?d")))
    before, units = paths(index), index._names("data")
    index.drop_tenant(" t2")
    assert index._names("data") == units
    assert paths(index) == {p: u for p, u in before.items() if p[0] != " t2"}
    assert {r[0] for r in rows(index.read())} == {"t1", "a=b/c?d"}
    assert len(rows(index.read(appid="a=b/c?d"))) == 40


def test_new_tenants_and_columns(spark, index):
    index.rebuild(some_docs(spark, ("t1",), 4))
    batch = spark.createDataFrame([("new", f"{i}", "c", i, 1, "x") for i in range(25)], DOCS + ", seq long, note string")
    index.upsert(batch)
    assert {f.buckets for (a, _), f in index.folders(index.current()).items() if a == "new"} == {4}
    assert index.read(appid="new").filter("note = 'x'").count() == 25
    assert index.read(appid="t1").filter("note IS NULL").count() == 4


def test_old_readers_and_cleaning(spark, index):
    first = index.rebuild(some_docs(spark, ("t1",)))
    reader = index.read()
    index.delete_terms({"type": "a"})
    assert reader.count() == 40 and index.read(first).count() == 40 and index.count() == 20
    index.delete_terms({"type": "b"})
    assert index.clean(keep=2) != [] and index.versions() == [2, 3]
    assert index.read(index.version(2)).count() == 20


def test_two_publishers_keep_both_changes(spark, index):
    """The second publisher comes between the first one's writing and publishing."""
    index.rebuild(some_docs(spark))
    other = BucketedIndex(spark, index.root, bucket_rows=10)
    ours = spark.createDataFrame([("t1", "t1-7", "z", 700, 1)], DOCS + ", seq long")

    def race(their_change):
        publish, done = index.publish, []

        def slow(*args):
            if not done:
                done.append(their_change())
            return publish(*args)

        index.publish = slow
        try:
            return index.upsert(ours, "replace")
        finally:
            index.publish = publish

    writes = []
    write, index._write = index._write, lambda docs: writes.append(1) or write(docs)
    race(lambda: other.delete_terms({"appid": "t2", "n": 3}))  # other buckets: the manifest alone is written again
    assert len(writes) == 1 and index.count() == 79 and ("t1", "t1-7", "z", 700) in rows(index.read())
    race(lambda: other.upsert(spark.createDataFrame([("t1", "t1-7", "y", 5, 1)], DOCS + ", seq long")))
    assert len(writes) == 3 and ("t1", "t1-7", "z", 700) in rows(index.read())
    race(lambda: other.rebuild(some_docs(spark, ("t1",), 200)))  # other numbers of buckets
    assert index.count() == 200 and ("t1", "t1-7", "z", 700) in rows(index.read())
    race(lambda: other.drop_tenant("t1"))
    assert rows(index.read()) == [("t1", "t1-7", "z", 700)]


def test_one_commit_per_number(spark, index):
    base = index.rebuild(some_docs(spark))
    folders = index.folders(base)
    assert index.publish(base, folders, base.schema, {}) is not None
    assert index.publish(base, folders, base.schema, {}) is None
    assert index.versions() == [1, 2] and index.current().seq == 2
    index.publish = lambda *args: None
    with pytest.raises(Conflict):
        index.drop_tenant("t1")


def test_hot_tenant_is_spread(spark, index):
    rng = random.Random(2)
    docs = [("big", f"{i}", "a", i) for i in range(300)] + [(f"s{i}", f"{i}", "a", i) for i in range(5)]
    rng.shuffle(docs)
    index.rebuild(spark.createDataFrame(docs, DOCS))
    sizes = [f.rows for (a, _), f in index.folders(index.current()).items() if a == "big"]
    assert sum(sizes) == 300 and max(sizes) < 40 and len(sizes) == 32
    plan = index.read(appid="big").filter(F.col("type") == "a")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type,a)" in plan


def test_statistics_follow_each_change(spark):
    """After every change counts and scores are those of a fresh index, without a look at the texts."""
    rng = random.Random(6)
    words = ["red", "green", "blue", "Red", "old", "new"]
    columns = "appid string, id string, type string, text string"

    def docs(n, seed):
        rng.seed(seed)
        return [(rng.choice(["t1", "t2"]), f"{rng.randint(0, 60)}-{i}", rng.choice(["a", "b", None]),
                 rng.choice([None, "", "!!", " ".join(rng.choices(words, k=rng.randint(1, 9)))])) for i in range(n)]

    index = BucketedIndex(spark, scratch_path(spark, "buckets"), 10, counted=("text",))
    index.rebuild(spark.createDataFrame(docs(80, 1), columns))

    def check():
        now = index.read()
        fresh = now.groupBy("type").count()
        assert sorted(map(tuple, index.counts_by_type().collect()), key=str) == sorted(map(tuple, fresh.collect()), key=str)
        clauses = [relevance.Clause("text", "red old"), relevance.Clause("text", "blue nowhere", 2.0)]
        want = {(r["appid"], r["id"]): r["score"] for r in relevance.search(now, clauses).collect()}
        kept = relevance.search(now, clauses, statistics=index.term_statistics())
        assert {(r["appid"], r["id"]): r["score"] for r in kept.collect()} == pytest.approx(want) and want

    check()
    index.upsert(spark.createDataFrame([(*r, n) for n, r in enumerate(docs(80, 1)[:20] + docs(15, 2))],
                                       columns + ", seq long"), "replace")
    check()
    index.delete_terms({"type": "a", "text": "green"})
    index.delete_ids(index.read().limit(5))
    check()
    index.drop_tenant("t2")
    check()
    index.clean(keep=1)
    check()
    index.drop_tenant("t1")
    assert index.counts_by_type().collect() == []
    with pytest.raises(ValueError):
        BucketedIndex(spark, index.root).statistics()


def test_keys_of_one_tenant_are_not_shuffled_to_one_task(spark, index):
    index.rebuild(some_docs(spark))
    keys = spark.range(100).select(F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("appid"),
                                   F.col("id").cast("string").alias("id"))
    plan = index.places(keys, index.folders(index.current()))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(appid" not in plan


def test_a_list_longer_than_a_task_may_hold_is_dealt_out(spark, index, monkeypatch):
    monkeypatch.setattr(buckets, "KEYS_PER_TASK", 20)
    seen, unindex = [], buckets.unindex
    monkeypatch.setattr(buckets, "unindex", lambda old, gone: seen.append(gone.count()) or unindex(old, gone))
    index.rebuild(some_docs(spark))
    gone = spark.range(1000).select(F.explode(F.array(F.lit("t1"), F.lit("t2"), F.lit("t9"))).alias("appid"),
                                    F.concat("appid", F.lit("-"), (F.col("id") * 3).cast("string")).alias("id"))
    index.delete_ids(gone.unionByName(gone))
    assert rows(index.read()) == [r for r in rows(some_docs(spark)) if r[3] % 3]
    assert seen == [28]  # the keys found and not the whole list
    index.delete_ids(gone)
    assert index.count() == 52 and seen == [28]


def test_documents_of_a_write_are_counted_without_a_sort(spark, index, monkeypatch):
    written, by_file = [], BucketedIndex._by_file
    monkeypatch.setattr(BucketedIndex, "_by_file", lambda self, path: written.append(by_file(self, path)) or written[-1])
    index.rebuild(some_docs(spark))
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    assert index.count() == 80

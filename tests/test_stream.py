"""Continuous indexing."""

import pytest
from conftest import ids
from pyspark.sql import functions as F
from test_maintain import OPS, apply, random_log, state

from docsift.operators.maintain import resolve_ops
from docsift.session import scratch_path
from docsift.streaming.runs import Runs
from docsift.streaming.ingest import (bulk_ingest, changed_state, latest_state, live_index,
                                      logged_ops)


def feed(spark, log, pieces):
    """The log as files, so that the stream takes one per micro-batch."""
    path = scratch_path(spark, "feed")
    for n in range(pieces):
        spark.createDataFrame(log[n::pieces], OPS).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_operations(spark):
    log, home = random_log(11, 200), scratch_path(spark, "s")
    stream = feed(spark, log, 3)
    bulk_ingest(stream, f"{home}/log", f"{home}/cp").awaitTermination()
    ops = logged_ops(spark, f"{home}/log")
    assert ops.count() == len(log)
    for mode in ("merge", "replace"):
        assert state(live_index(None, ops, mode)) == apply(log, mode)
    # started again with nothing new to read, the log stays as it is
    bulk_ingest(stream, f"{home}/log", f"{home}/cp").awaitTermination()
    assert logged_ops(spark, f"{home}/log").count() == len(log)


def test_on_top_of_a_base(spark):
    log = random_log(12, 300)
    base = resolve_ops(spark.createDataFrame([r for r in log if r[2] < 150], OPS), "merge")
    ops = spark.createDataFrame([r for r in log if r[2] >= 150], OPS)
    assert state(live_index(base, ops, "merge")) == apply(log, "merge")


def test_latest(spark):
    log = [r for r in random_log(13, 200) if r[3] == "put"]
    home = scratch_path(spark, "s")
    latest_state(feed(spark, log, 3).drop("op"), f"{home}/log", f"{home}/cp").awaitTermination()
    got = changed_state(spark, f"{home}/log")
    assert state(got) == apply(log, "replace")
    assert len(ids(got)) == len({r[1] for r in log})


def test_latest_over_many_batches_keeps_few_folders(spark):
    log = [r for r in random_log(14, 400) if r[3] == "put"]
    home = scratch_path(spark, "s")
    stream = feed(spark, log, 20).drop("op")
    latest_state(stream, f"{home}/log", f"{home}/cp", every=3).awaitTermination()
    assert state(changed_state(spark, f"{home}/log")) == apply(log, "replace")
    runs = Runs(spark, f"{home}/log", 3)
    assert runs.current() == [(0, 8), (9, 17), (18, 18), (19, 19)]
    # besides these, only what was hidden within the last three batches is still there
    assert runs.complete() == [(0, 8), (9, 11), (9, 17), (12, 14), (15, 15), (15, 17), (16, 16), (17, 17), (18, 18), (19, 19)]


def test_runs_that_break_off(spark):
    def rows(n):
        return spark.createDataFrame([(f"k{n % 4}", n), ("all", n)], "id string, seq int")

    def merge(df):
        return df.groupBy("id").agg(F.max("seq").alias("seq"))

    def seen():
        return {r["id"]: r["seq"] for r in merge(runs.read()).collect()}

    runs = Runs(spark, scratch_path(spark, "runs"), 2)
    with pytest.raises(ValueError):
        runs.read()
    for n in range(7):
        runs.add(rows(n), n, merge)
    want = {f"k{k}": max(n for n in range(7) if n % 4 == k) for k in range(4)} | {"all": 6}
    assert seen() == want
    # the job dies while it merges: the folder is there without its mark, and readers go on with the runs within it
    (fs, mark) = runs._at(runs.folder((4, 5)) + "/_SUCCESS")
    assert fs.delete(mark, False) and (4, 4) in runs.current() and seen() == want
    # the batch is run again, and the merges that are due then
    runs.add(rows(7), 7, merge)
    assert runs.current() == [(0, 7)] and seen() == want | {"k3": 7, "all": 7}
    runs.add(rows(7), 7, merge)
    assert runs.current() == [(0, 7)] and seen() == want | {"k3": 7, "all": 7}
    # readers of the time before still find their files
    assert (0, 3) in runs.complete()
    for n in range(8, 40):
        runs.add(spark.range(0).selectExpr("'' id", "1 seq"), n, merge)
    assert len(runs.complete()) < 12 and seen() == want | {"k3": 7, "all": 7}

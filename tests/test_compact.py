"""The way from a log of operations to the published index."""

import json
import random

import pytest

from docsift.session import scratch_path
from docsift.sources.buckets import BucketedIndex
from docsift.streaming.compact import LoggedIndex, follow
from docsift.streaming.ingest import bulk_ingest

OPS = "appid string, id string, seq long, op string, terms string, x string, n long"


def random_ops(seed, size=300):
    rng, out = random.Random(seed), []
    for seq in range(size):
        id, kind = f"k{rng.randint(0, 25)}", rng.random()
        if kind < 0.12:
            out.append(("a", id, seq, "delete", None, None, None))
        elif kind < 0.2:
            terms = rng.choice([{"x": "red"}, {"n <": 10}, {"x": "blue", "n >=": 30}])
            out.append((None, None, seq, "delete_terms", json.dumps(terms), None, None))
        else:
            out.append(("a", id, seq, "put", None, rng.choice(["red", "blue", None]), rng.choice([None, *range(60)])))
    return out


def apply(ops):
    """One operation after another, in the order of `seq`."""
    docs = {}
    for _, id, _, op, terms, x, n in sorted(ops, key=lambda r: r[2]):
        if op == "put":
            docs[id] = (x, n)
        elif op == "delete":
            docs.pop(id, None)
        else:
            t = json.loads(terms)
            docs = {i: (x, n) for i, (x, n) in docs.items() if not (
                ("x" not in t or x == t["x"]) and ("n <" not in t or n is not None and n < t["n <"])
                and ("n >=" not in t or n is not None and n >= t["n >="]))}
    return docs


class Log:
    def __init__(self, spark, bucket_rows=4):
        self.spark, self.home, self.n = spark, scratch_path(spark, "log"), 0
        self.index = BucketedIndex(spark, f"{self.home}/index", bucket_rows)
        self.logged = self.again()

    def again(self):
        return LoggedIndex(BucketedIndex(self.spark, f"{self.home}/index", 4), f"{self.home}/log")

    def put(self, ops):
        self.spark.createDataFrame(ops, OPS).coalesce(2).write.parquet(f"{self.home}/log/batch={self.n}")
        self.n += 1


def state(df):
    rows = [tuple(r) for r in df.select("id", "x", "n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {i: (x, n) for i, x, n in rows}


def folders(log):
    return sorted(n for n in log.index._names("../log") if n.startswith("batch="))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_any_compaction(spark, seed):
    rng, ops, log = random.Random(seed), random_ops(seed), Log(spark)
    rng.shuffle(ops)  # late operations, also behind a compaction
    for start in range(0, 300, 75):
        log.put(ops[start:start + 75])
        assert state(log.logged.read()) == apply(ops[:start + 75])
        if rng.random() < 0.7 or start == 0:
            log.logged.compact()
            assert folders(log) == [] and state(log.logged.read()) == apply(ops[:start + 75])


def test_killed_between_publishing_and_truncating(spark, monkeypatch):
    ops, log = random_ops(5), Log(spark)
    log.put(ops[:100])
    log.logged.compact()
    log.put(ops[100:200])

    def killed(consumed):
        raise KeyboardInterrupt

    monkeypatch.setattr(log.logged, "truncate", killed)
    with pytest.raises(KeyboardInterrupt):
        log.logged.compact()
    assert folders(log) == ["batch=1"] and log.index.current().notes["consumed"] == 1
    after = log.again()
    assert state(after.read()) == apply(ops[:200])
    seq = log.index.current().seq
    after.compact()
    assert log.index.current().seq == seq and folders(log) == [] and state(after.read()) == apply(ops[:200])
    # a stream that runs its last batch again writes a batch that is known
    log.n = 1
    log.put(ops[100:200])
    assert after._pending(log.index.current()) == []
    after.compact()
    assert folders(log) == [] and log.index.current().seq == seq


def test_killed_before_publishing(spark, monkeypatch):
    ops, log = random_ops(6, 120), Log(spark)
    log.put(ops)
    monkeypatch.setattr(log.logged.index, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        log.logged.compact()
    after = log.again()
    assert state(after.read()) == apply(ops)
    after.compact()
    assert state(after.read()) == apply(ops) and folders(log) == []


def test_two_compactions_at_once(spark):
    ops, log = random_ops(7, 160), Log(spark)
    log.put(ops[:80])
    log.logged.compact()
    log.put(ops[80:])
    mine, other = log.logged, log.again()
    publish, done = mine.index.publish, []

    def slow(*args):
        if not done:
            done.append(other.compact())
        return publish(*args)

    mine.index.publish = slow
    mine.compact()
    assert state(other.read()) == apply(ops) and folders(log) == []


def test_unfinished_batches_wait(spark):
    log = Log(spark)
    for n in range(3):
        log.put([("a", f"k{n}", n, "put", None, "x", n)])
    fs, path = log.logged._hadoop(f"{log.home}/log/batch=1/_SUCCESS")
    fs.delete(path, False)
    assert log.logged.batches() == [0] and set(state(log.logged.read())) == {"k0"}
    log.logged.compact()
    assert log.index.current().notes["consumed"] == 0 and folders(log) == ["batch=1", "batch=2"]


def test_only_touched_buckets_are_written(spark):
    log = Log(spark)
    log.put([("a", f"k{i}", i, "put", None, "red" if i == 5 else "blue", i) for i in range(40)])
    log.logged.compact()

    def paths():
        return {p: f.path for p, f in log.index.folders(log.index.current()).items()}

    before = paths()
    log.put([("a", "k3", 100, "put", None, "green", 1)])
    log.logged.compact()
    after = paths()
    assert len(before) > 5 and sum(before[p] != after[p] for p in before) == 1
    log.put([(None, None, 101, "delete_terms", '{"x": "red"}', None, None)])
    log.logged.compact()
    assert sum(after[p] != paths().get(p) for p in after) == 1 and "k5" not in state(log.logged.read())


def test_forgetting(spark):
    log = Log(spark)
    log.put([("a", "1", 1, "put", None, "red", 1), ("a", "2", 2, "delete", None, None, None),
             (None, None, 3, "delete_terms", '{"x": "red"}', None, None), ("a", "3", 4, "put", None, "red", 1)])
    log.logged.compact(forget=4)
    assert log.index.read().count() == 1 and log.index.current().notes["markers"] == {}
    assert state(log.logged.read()) == {"3": ("red", 1)}


def test_odd_rows(spark):
    log = Log(spark)
    with pytest.raises(ValueError):
        log.logged.read()
    log.put([("a", "1", 1, "put", None, "red", 1), (None, "2", 2, "put", None, "red", 1), ("a", " ", 2, "put", None, "red", 1)]
            + [(None, None, 9, "delete_terms", t, None, None)
               for t in (None, "{}", "[1]", "no json", '{"unknown": "red"}', '{"n": "word"}', '{"x": " "}')])
    assert state(log.logged.read()) == {"1": ("red", 1)}
    log.logged.compact()
    assert state(log.logged.read()) == {"1": ("red", 1)}
    log.put([])
    log.logged.compact()
    assert state(log.logged.read()) == {"1": ("red", 1)} and folders(log) == []


def test_from_a_stream(spark):
    ops, home = random_ops(8, 120), scratch_path(spark, "s")
    for n in range(3):
        spark.createDataFrame(ops[n::3], OPS).coalesce(1).write.mode("append").parquet(f"{home}/feed")
    schema = spark.createDataFrame([], OPS).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/feed")
    bulk_ingest(stream, f"{home}/log", f"{home}/cp").awaitTermination()
    logged = LoggedIndex(BucketedIndex(spark, f"{home}/index"), f"{home}/log")
    assert state(logged.read()) == apply(ops)
    logged.compact()
    assert state(logged.read()) == apply(ops)


def test_following_a_stream_keeps_few_files(spark):
    ops, home = random_ops(9, 140), scratch_path(spark, "s")
    for n in range(7):
        spark.createDataFrame(ops[n::7], OPS).coalesce(1).write.mode("append").parquet(f"{home}/feed")
    schema = spark.createDataFrame([], OPS).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/feed")
    index = BucketedIndex(spark, f"{home}/index", 20)
    logged = LoggedIndex(index, f"{home}/log")
    follow(stream, logged, f"{home}/cp", every=2).awaitTermination()
    assert len(logged.batches()) == 1 and len(index.versions()) == 2 and index.current().notes["consumed"] == 5
    assert state(logged.read()) == apply(ops)
    # started again with nothing new
    follow(stream, logged, f"{home}/cp", every=2).awaitTermination()
    assert state(logged.read()) == apply(ops)

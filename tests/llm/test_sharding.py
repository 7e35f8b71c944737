import random
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb, sqrt

from helpers import documents, edges, empty
from pyspark.sql import functions as F

from docsift.llm import sharding as S


def test_one_draw_follows_the_exact_law(spark):
    cases = [(20, 7, 5), (9, 9, 4), (6, 0, 3), (5, 2, 5), (1, 1, 1), (0, 0, 0), (200, 100, 60), (1000, 3, 900)]
    trials = 4000
    for n, k, d in cases:
        table = spark.range(trials).select(
            F.lit(n).cast("long").alias("n"), F.lit(k).cast("long").alias("k"), F.lit(d).cast("long").alias("d"),
            ((F.col("id") + 0.5) / trials).alias("u"))
        got = Counter(r[0] for r in table.select(S.hypergeometric(
            F.col("u"), F.col("n"), F.col("k"), F.col("d"))).collect())
        for x in range(max(0, d + k - n), min(k, d) + 1):
            p = Fraction(comb(k, x) * comb(n - k, d - x), comb(n, d))
            # evenly spread uniform numbers meet each outcome in proportion, up to the two at its borders
            assert abs(got.pop(x, 0) - trials * p) <= 1.01, (n, k, d, x)
        assert not got


def matrix_of(spark, sizes, shards, seed=3):
    total = sum(sizes.values())
    capacities = [total // shards + (j < total % shards) for j in range(shards)]
    table = spark.createDataFrame(list(sizes.items()), "part long, n long")
    lines = {r["part"]: r["line"] for r in S.communication_matrix(table, capacities, seed).collect()}
    assert set(lines) == set(sizes)
    assert all(sum(line) == sizes[p] and min(line) >= 0 for p, line in lines.items())
    assert [sum(line[j] for line in lines.values()) for j in range(shards)] == capacities
    return lines


def test_matrix_adds_up_over_a_tree_of_several_levels(spark):
    rng = random.Random(4)
    sizes = {p: rng.randint(1, 40) for p in range(0, 1500, 2)} | {1001: 9000}
    matrix_of(spark, sizes, 16)
    matrix_of(spark, {0: 1}, 16)
    matrix_of(spark, {5: 3, 40: 2}, 7)


def test_matrix_has_the_mean_and_spread_of_a_shuffle(spark):
    sizes = {p: 60 for p in range(40)}
    values = [x for seed in range(6) for line in matrix_of(spark, sizes, 8, seed * 100).values() for x in line]
    mean = sum(values) / len(values)
    variance = sum((x - mean) ** 2 for x in values) / len(values)
    total, share = 2400, 1 / 8
    expected = 60 * share * (1 - share) * (total - 60) / (total - 1)
    assert mean == 7.5 and abs(variance - expected) < 4 * expected * sqrt(2 / len(values))


def check(rows, n, shards=16):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == n and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((len(slots[j]) for j in range(shards)), reverse=True) == [len(slots[j]) for j in range(shards)]
    assert len(slots[0]) - len(slots[shards - 1]) <= 1


def test_every_row_once_and_shards_of_equal_size(spark):
    rows = [(i, f"text {i % 7}") for i in range(999)]
    docs = documents(spark, rows).repartition(9, "doc_id")
    out = S.deal(docs, 16).collect()
    check(out, 999)
    assert sorted((r["doc_id"], r["text"], r["node"]) for r in out) == sorted((i, t, "clash") for i, t in rows)


def test_blocks_do_not_show(spark, monkeypatch):
    docs = documents(spark, [(i, None) for i in range(400)]).repartition(5, "doc_id")
    monkeypatch.setattr(S, "BLOCK_ROWS", 4)
    check(S.deal(docs, 3).collect(), 400, 3)
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    check(S.deal(docs, 3).collect(), 400, 3)


def test_order_is_uniform(spark):
    """Copies of one row and neighbours in the input are spread over shards and slots like any others."""
    docs = spark.range(0, 6400, 1, 8).select((F.col("id") >= 1600).cast("int").alias("kind"))
    counts = Counter((r["shard"], r["kind"]) for r in S.deal(docs, 16).collect())
    sd = sqrt(400 * 0.25 * 0.75)
    assert all(abs(counts[j, 0] - 100) < 4.5 * sd for j in range(16))
    docs = spark.range(0, 6400, 1, 8)
    firsts = [r["slot"] for r in S.deal(docs, 16).filter("id < 800").collect()]
    assert abs(sum(firsts) / 800 - 199.5) < 4.5 * 400 / sqrt(12 * 800)


def test_same_seed_same_deal(spark):
    docs = documents(spark, [(i, f"t{i}") for i in range(300)]).repartition(4, "doc_id")
    one, two, other = (sorted((r["doc_id"], r["shard"], r["slot"]) for r in S.deal(d, 16, seed).collect())
                       for d, seed in ((docs, 20), (docs.sortWithinPartitions(F.desc("doc_id")), 20), (docs, 21)))
    assert one == two != other


def test_edges(spark):
    out = S.digests(edges(spark)).collect()
    check(out, edges(spark).count())
    by_text = {(r["doc_id"], r["size"], r["text_crc32"]) for r in out}
    assert {(3, 1, 0), (4, 1, 0), (None, 1, 0)} <= by_text
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in out)
    assert S.digests(empty(spark)).collect() == []
    again = S.deal(S.deal(edges(spark), 4).withColumn("_part", F.lit(1)).withColumn("part", F.lit("x")), 4)
    assert again.columns[-4:] == ["_part", "part", "shard", "slot"] and again.filter("part = 'x' AND _part = 1").count() == 18


def test_maps_and_files(spark, tmp_path):
    docs = spark.range(50).select("id", F.create_map(F.lit("a"), "id").alias("m"))
    S.write_shards(S.deal(docs, 4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    check(back.collect(), 50, 4)
    assert {r["m"]["a"] for r in back.collect()} == set(range(50))


def test_no_python(spark):
    plan = S.digests(edges(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from docsift.llm import vectorcodes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, dist string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def f32(x):
    return x if x is None else float(np.float32(x))


def plain(rows, parts=8, entries=16, rounds=6):
    """All parts compared with all entries in every round, in plain Python integers."""
    kept = [(i, [f32(x) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(f32(x)) for x in v)]
    if not kept:
        return {}, []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = []
    for _, v, _ in kept:
        ints, w = [math.floor(x * 4096) for x in v], len(v) // parts
        cut.append([ints[p * w:(p + 1) * w] for p in range(parts)])
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
                 for p, x in enumerate(c)] for c in cut]

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, n in zip(cut, near) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    rows = []
    totals = {}
    for (i, _, g), n in zip(kept, assign()):
        error = sum(d for d, _ in n)
        totals[g] = totals.get(g, 0) + error
        rows.append((i, "".join(f"{k:02x}" for _, k in n), error, g))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[g], digest) for i, c, e, g in rows), key=str), books


def run(df):
    return sorted(map(tuple, V.digests(df).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def some_vectors(n, size=16, seed=1, spread=0.1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(9)]
    return [(i * 3 - 20, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.choice([None, 0, 1, 2]))
            for i in range(n)]


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(90)
    rows += [(1, None, 1), (2, [None] * 16, 1), (3, [nan] * 16, 1), (4, [inf] + [0.0] * 15, 0), (5, [-inf] + [0.0] * 15, None),
             (6, [None] + [1.0] * 15, 2), (None, [0.5] * 16, 3), (None, [0.25] * 16, 3), (7, [-0.0] * 16, None),
             (8, [1e-9, -1e-9] * 8, None), (9, [3.0, -7.5] * 8, -1)]
    return rows + rows[:30] + [(-15, rows[3][1], 0)] * 80


@pytest.mark.parametrize("rows", [some_vectors(200), some_vectors(5), some_vectors(400, 8, 4, 0.0), odd_vectors(),
                                  [(i, [0.125] * 8, None) for i in range(60)], some_vectors(1)])
def test_against_plain_python(spark, rows):
    assert run(frame(spark, rows)) == plain(rows)[0]


def test_against_sql():
    for rows in (some_vectors(150), odd_vectors(), some_vectors(4)):
        con = duckdb.connect()
        con.execute("CREATE TABLE embeddings(vec_id BIGINT, embedding FLOAT[], label INTEGER)")
        con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
        got = con.execute("SELECT vec_id, code, error, label_error, codebooks_sha256 FROM (" + V.rounds_sql() + ")").fetchall()
        assert sorted(got, key=str) == plain(rows)[0]


def test_ties_take_the_lower_entry():
    entries = np.array([[0], [4], [2], [2]])
    assert V.nearest(np.array([[2], [1], [3], [9]]), entries)[0].tolist() == [2, 0, 1, 1]
    # entry 1 moves next to the part of entry 2, at the same distance: the lower index takes it; entry 3 does not
    at, dist = np.array([2, 2]), np.array([1, 1])
    parts = np.array([[1], [3]])
    moved = np.array([False, True, False, True])
    new, far, _ = V.reassign(parts, np.array([[90], [2], [2], [2]]), moved, at, dist)
    assert new.tolist() == [1, 1] and far.tolist() == [1, 1]
    new, _, _ = V.reassign(parts, np.array([[90], [80], [2], [2]]), moved, at, dist)
    assert new.tolist() == [2, 2]


def test_active_entries_only():
    """Random moves: the same as a complete comparison, with fewer pairs."""
    rng = np.random.default_rng(3)
    parts = rng.integers(-6, 7, (3000, 2))
    entries = rng.integers(-6, 7, (16, 2))
    at, dist = V.nearest(parts, entries)
    for _ in range(30):
        moved = np.zeros(16, bool)
        moved[rng.choice(16, rng.integers(0, 4), replace=False)] = True
        entries = np.where(moved[:, None], rng.integers(-6, 7, (16, 2)), entries)
        at, dist, pairs = V.reassign(parts, entries, moved, at, dist)
        want = V.nearest(parts, entries)
        assert (at == want[0]).all() and (dist == want[1]).all()
        assert pairs < 3000 * 16 and (moved.any() or pairs == 0)


def test_rounds_compare_less_and_keep_two_tables(spark):
    rows = some_vectors(300, 8, 6, 0.0)
    codes = V.compress(frame(spark, rows))
    assert len(codes.compared) == V.ROUNDS + 1 and codes.compared[0] == 300 * 8 * 16
    assert codes.compared[-1] < codes.compared[0]
    assert codes.codebooks.tolist() == plain(rows)[1]
    folder = codes.rows.inputFiles()[0].rsplit("/", 2)[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    left = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert [f.getPath().getName() for f in left] == [f"pass-{V.ROUNDS}"]


def test_large_components_stay_exact_or_raise(spark):
    rows = [(i, [x * 9000.0 for x in v], g) for i, v, g in some_vectors(60)]
    assert run(frame(spark, rows)) == plain(rows)[0]
    with pytest.raises(OverflowError):
        run(frame(spark, [(1, [1e30] * 8, 0)]))
    with pytest.raises(ValueError):
        run(frame(spark, [(1, [1.0] * 9, 0)]))
    with pytest.raises(ValueError):
        run(frame(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)]))


def test_edges(spark):
    assert run(frame(spark, []).limit(0)) == []
    assert run(frame(spark, [(1, None, 1), (2, [float("nan")] * 8, 1)])) == []
    assert run(frame(spark, [(1, [], 1), (2, [], None)])) == plain([(1, [], 1), (2, [], None)])[0]
    doubles = frame(spark, some_vectors(50)).selectExpr("vec_id", "CAST(embedding AS array<double>) embedding", "label")
    assert run(doubles) == plain(some_vectors(50))[0]
    many = [(i, v, i) for i, v, _ in some_vectors(50)]
    assert run(frame(spark, many)) == plain(many)[0]


def test_labels_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(V, "BROADCAST_BYTES", 0)
    rows = odd_vectors()
    assert run(frame(spark, rows)) == plain(rows)[0]

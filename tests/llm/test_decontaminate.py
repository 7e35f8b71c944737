import random

import numpy as np
import pytest
from helpers import documents, edge_texts, edges, empty, prose

from docsift.llm import decontaminate as D
from docsift.llm import texts as T


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").selectExpr("*", "7 AS doc_id", "'x' AS end")


def edit(text, share, seed):
    rng, out = random.Random(seed), list(text)
    for _ in range(int(len(out) * share)):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcde")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcde"))
    return "".join(out)


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(4))
def test_distance(seed):
    item, text = prose(seed, 12), prose(seed + 9, 30) + edit(prose(seed, 12), 0.2, seed) + prose(seed + 5, 9)
    want = slow_distance(item, text)
    assert D.distance_within(item, text, len(item))[0] == want
    assert D.distance_within(item, text, want - 1)[0] == want


BENCH = [(i, prose(100 + i, 15 + i % 20, 5000)) for i in range(30)]


def test_planted_passages(spark):
    rows, want, heavy = [], set(), set()
    for i in range(90):
        body = prose(1000 + i, 150, 5000)
        if i % 3 == 0:
            k = i // 3
            share = [0, 0.03, 0.1][i % 9 // 3]
            at = len(body) // 2
            body = f"{body[:at]} {edit(BENCH[k][1], share, i).upper() if i % 2 else edit(BENCH[k][1], share, i)}\n{body[at:]}"
            (heavy if share == 0.1 else want).add((i, k))
        rows.append((i, body))
    found = D.leaks(documents(spark, rows), items(spark, BENCH)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    # unchanged and lightly edited passages are found; of heavily edited short ones the sampling may miss some
    assert want <= got <= want | heavy and len(heavy - got) <= 3
    assert all(r["distance"] * 100 <= 25 * r["item_chars"] for r in found)
    kept = D.drop_leaks(documents(spark, rows), items(spark, BENCH))
    assert kept.columns == documents(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(90)) - {d for d, _ in got}


def test_edges(spark):
    odd = items(spark, [(1, None), (2, ""), (3, "  "), (None, prose(1, 30)), (4, "one"), (5, prose(1, 30)), (5, prose(1, 30))])
    got = sorted((str(r["doc_id"]), r["item_id"], r["distance"]) for r in D.leaks(edges(spark), odd).collect())
    assert got == sorted([("1", 5, 0), ("2", 5, 0), ("2", 5, 0), ("12", 5, 0), ("11", 5, 0), ("6", 4, 0), ("7", 4, 0)])
    assert D.leaks(empty(spark), odd).count() == D.leaks(edges(spark), odd.limit(0)).count() == 0
    assert D.drop_leaks(edges(spark), odd.limit(0)).count() == len(edge_texts())


def test_blocks_give_the_same(spark, monkeypatch):
    docs = documents(spark, [(i, prose(i, 40) + " " + t) for i, t in BENCH])
    want = sorted(map(tuple, D.leaks(docs, items(spark, BENCH)).collect()))
    monkeypatch.setattr(D, "BLOCK", 900)
    assert sorted(map(tuple, D.leaks(docs, items(spark, BENCH)).collect())) == want


def spread(text, step):
    """One letter in each `step`-th word is another one."""
    words = text.split(" ")
    for i in range(0, len(words), step):
        at = len(words[i]) // 2
        words[i] = words[i][:at] + "x" + words[i][at + 1:]
    return " ".join(words)


@pytest.mark.parametrize("change", [
    lambda t, i: spread(t, 2), lambda t, i: spread(t, 1), lambda t, i: edit(t, 0.05, i), lambda t, i: edit(t, 0.15, i),
    lambda t, i: edit(t, 0.25, i), lambda t, i: "".join("x" if n % 5 == 2 else c for n, c in enumerate(t))])
def test_edited_passages(change):
    searcher = D.Searcher(BENCH)
    texts = [prose(3000 + i, 40, 5000) + " " + change(t, i) + " " + prose(4000 + i, 40, 5000) for i, t in BENCH]
    found = {(n, k) for n, k, *_ in searcher.search(texts)}
    want = {(n, n) for n, t in enumerate(texts)
            if slow_distance(BENCH[n][1], t) * 100 <= D.DISTANCE * len(BENCH[n][1])}
    assert want and len(want - found) * 50 <= len(want)


@pytest.mark.parametrize("words", [1, 2, 5, 9, 14, 30, 60, 200])
def test_distances_of_items_of_any_length(words):
    items_ = [(i, prose(i, words)) for i in range(6)]
    texts = [prose(50 + i, 20) + edit(t, i / 25, i) + prose(70 + i, 20) for i, t in items_] + ["", "a", items_[0][1]]
    searcher = D.Searcher(items_)
    got = {(n, k): (d, end) for n, k, d, end in searcher.search(texts)}
    for n, text in enumerate(texts):
        for k, (_, item) in enumerate(searcher.items):
            want = D.distance_within(item, text, searcher.most[k])
            if (n, k) in got or n == k:
                assert got.get((n, k)) == (want if want[0] <= searcher.most[k] else None)
    assert (8, 0) in got and got[8, 0] == (0, len(items_[0][1]))


def test_items_without_spaces_and_inside_words(spark):
    unspaced = "".join(chr(0x4E00 + random.Random(i).randrange(3000)) for i in range(40))
    around = "".join(chr(0x4E00 + random.Random(100 + i).randrange(3000)) for i in range(300))
    code = "for(i=0;i<n;i++){sum+=table[i]*weight[n-i];}"
    bench = items(spark, [(1, unspaced), (2, code), (3, "photosynthesis")])
    docs = documents(spark, [(1, around[:150] + unspaced + around[150:]), (2, f"x;{code}return(sum)"),
                             (3, "What is it? Photosynthesis, of course."), (4, around)])
    got = {(r["doc_id"], r["item_id"], r["distance"], r["end"]) for r in D.leaks(docs, bench).collect()}
    assert got == {(1, 1, 0, 190), (2, 2, 0, 2 + len(code)), (3, 3, 0, 26)}
    assert [r["doc_id"] for r in D.drop_leaks(docs, bench).collect()] == [4]


def test_short_and_long_items_are_compared_apart(monkeypatch):
    items = [(0, prose(1, 12, 300)), (1, prose(2, 120, 300))]
    searcher, asked = D.Searcher(items), []
    inner = D.Searcher._side_by_side

    def spy(self, points, item, start, end):
        words = int(self.chars[item].max() + 63) // 64
        asked.append((words * int((end - start).max()) * len(item), int((words * (end - start)).sum())))
        return inner(self, points, item, start, end)

    monkeypatch.setattr(D.Searcher, "_side_by_side", spy)
    texts = [D.normal(prose(10 + i, 30, 300) + " " + items[i % 50 == 0][1]) for i in range(300)]
    found = searcher.search(texts)
    assert {(i, int(i % 50 == 0)) for i in range(300)} <= {(n, k) for n, k, *_ in found}
    assert len(asked) > 1 and sum(a for a, _ in asked) < 4 * sum(b for _, b in asked)


def test_parts_that_end_early_keep_their_distance():
    rng = np.random.default_rng(3)
    items = [(k, prose(50 + k, 10 + 7 * k, 300)) for k in range(12)]
    searcher = D.Searcher(items)
    text = D.normal(" ".join(t[:len(t) * 9 // 10] + prose(90 + k, 4, 300) for k, (_, t) in enumerate(items)))
    points = D._points(text)
    item = rng.integers(0, 12, 300)
    start = rng.integers(0, len(text) - 20, 300)
    end = np.minimum(start + rng.integers(1, 700, 300), len(text))
    best, where = searcher._side_by_side(points, item, start, end)
    for k, a, b, d, at in zip(item.tolist(), start.tolist(), end.tolist(), best.tolist(), where.tolist()):
        most = int(searcher.most[k])
        want, place = D.distance_within(searcher.items[k][1], text[a:b], most)
        assert (d, at) == (want, place) if want <= most else d > most


def test_batches_of_long_texts_are_small(spark, monkeypatch):
    inner, bound = T.chunks, T.BATCH

    def spy(batches, *names):
        for batch in batches:
            if batch.nbytes > 2 * bound:
                raise ValueError(f"a batch of {batch.nbytes} bytes")
            yield from inner(iter([batch]), *names)

    monkeypatch.setattr(D, "chunks", spy)
    docs = documents(spark, [(0, "z")]).repartition(1).selectExpr("doc_id", "repeat(text, 50000) AS text", "explode(sequence(1, 300)) AS row")
    now = spark.conf.get(T.BATCH_SETTING, None)
    try:
        for step, want in ((D.leaks, 0), (D.drop_leaks, 300)):
            spark.conf.unset(T.BATCH_SETTING)
            assert step(docs, items(spark, BENCH)).count() == want
        spark.conf.set(T.BATCH_SETTING, "1000")
        T.small_batches(spark)
        assert spark.conf.get(T.BATCH_SETTING) == "1000"
    finally:
        spark.conf.set(T.BATCH_SETTING, now) if now else spark.conf.unset(T.BATCH_SETTING)


def test_memory_goes_back_after_the_last_batch(monkeypatch):
    done = []
    monkeypatch.setattr(T.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: done.append(1)})())
    batch = T.pa.RecordBatch.from_pydict({"text": ["a" * 30, None, "b"]})
    assert [c.num_rows for c in T.chunks(iter([batch, batch]), size=20)] == [1, 2, 1, 2] and done == [1]

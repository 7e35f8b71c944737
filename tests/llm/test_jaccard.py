import random
import re

import pytest
from helpers import documents, edge_texts, edges, empty, prose

from docsift.llm import jaccard as J

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """(doc_id, n_shingles, component) of each row; a null id takes no part."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for b, (j, t) in enumerate(sets[:a]):
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                parent[find(a)] = find(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            root = find(a)
            least[root] = min(least.get(root, i), i)
    return sorted(((i, len(s), None if i is None else least[find(a)]) for a, (i, s) in enumerate(sets)), key=str)


def run(docs):
    return sorted(map(tuple, J.join(docs).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def near_copies(seed):
    rng, rows = random.Random(seed), []
    for family in range(12):
        base = prose(seed * 100 + family, rng.choice([3, 6, 8, 10, 14, 18, 40, 120]), 60).split()
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 20))):
                at = rng.randrange(len(words))
                words[at:at + rng.randint(0, 1)] = [rng.choice(base)] * rng.randint(0, 2)
            rows.append((len(rows), " ".join(words)))
    common = prose(seed, 30, 60)
    rows += [(len(rows) + k, common + " " + prose(seed + k, rng.choice([2, 5, 60]), 60)) for k in range(25)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = near_copies(seed)
    assert run(documents(spark, rows).repartition(4)) == brute(rows)


@pytest.mark.parametrize("x", [0, 6, 12])
def test_any_boundary_gives_the_same(spark, monkeypatch, x):
    monkeypatch.setattr(J, "boundary", lambda *a: x)
    monkeypatch.setattr(J, "COUNTED", 500)
    rows = near_copies(3)
    assert run(documents(spark, rows)) == brute(rows)


def test_boundary_goes_by_cost():
    none = [(n, 100, 100 * n, 1) for n in range(15)]
    crowded = [(n, 100, 10_000 * n, 50) for n in range(15)]
    assert J.boundary(none) <= J.boundary(crowded) and J.boundary(crowded) >= 5


def test_edges(spark):
    assert run(edges(spark)) == brute(edge_texts())
    assert run(empty(spark)) == []


def test_one_of_each_group_stays(spark):
    rows = near_copies(4)
    kept = sorted(r["doc_id"] for r in J.drop_near_copies(documents(spark, rows)).collect())
    assert kept == sorted({c for _, _, c in brute(rows)})
    docs = edges(spark)
    out = J.drop_near_copies(docs)
    assert out.columns == docs.columns
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect())
    assert ("2", prose(1, 120)) not in got and got.count(("1", prose(1, 120))) == 1
    assert sum(i == "None" for i, _ in got) == 2 and {"3", "4", "5"} <= {i for i, _ in got}
    assert J.drop_near_copies(empty(spark)).collect() == []

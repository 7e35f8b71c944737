import random

import pytest
from helpers import edge_texts, edges, empty, prose

from docsift.llm import toxicity as T


def distance(a, b):
    """Edits, a swap of neighbours being one."""
    rows = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[-1][-1]


@pytest.mark.parametrize("seed", range(3))
def test_automaton_against_distances(seed):
    rng = random.Random(seed)
    make = lambda a, b: "".join(rng.choice("abcd") for _ in range(rng.randint(a, b)))
    terms = sorted({make(3, 8) for _ in range(25)})
    automaton = T.Automaton(terms)
    for _ in range(3000):
        word = make(0, 9)
        near = [(d, k) for k, t in enumerate(terms) if (d := distance(word, t)) <= (1 if len(t) >= T.MISSPELLED else 0)]
        assert automaton.match(word) == (min(near)[::-1] if near else None)


def test_stems():
    automaton = T.Automaton(["gromp*", "grompel", "vlask"])
    assert automaton.match("grompist") == (0, 0) and automaton.match("grompel") == (1, 0)
    assert automaton.match("gromp") is None and automaton.match("vlaks") == (2, 1)


def toxic_table(spark):
    rng, rows, labels = random.Random(3), [], []
    for i in range(1500):
        text = prose(i, 60, 900)
        toxic = i % 5 == 0
        if toxic:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["gromp", "vlask", "snudge", "drivel"]))
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    extra = [(5001, "one gormp and a vlaask " + prose(7, 30, 900)), (5002, None), (5003, ""), (5004, prose(8, 50, 900))]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string").selectExpr("*", "'x' AS word", "1 AS toxic")
    return docs, spark.createDataFrame([*labels, (9999, 1), (7, None), (None, 1)], "doc_id bigint, toxic int").selectExpr(
        "*", "'x' AS text"), dict(labels)


def test_held_out_accuracy(spark):
    docs, labels, truth = toxic_table(spark)
    got = {r["doc_id"]: r for r in T.score(docs, labels).collect()}
    held = [i for i in truth if got[i]["held_out"]]
    assert 400 < len(held) < 600
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.98 * len(held)
    assert got[5001]["score"] > 5 * got[5004]["score"]  # two misspelled terms
    assert got[5002]["score"] == got[5003]["score"] == pytest.approx(got[5004]["score"])
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def test_quoted_terms_weigh_less():
    scorer = T.Scorer(["gromp"], [3.0])
    plain, quoted = (scorer.features(t) for t in ("you gromp go home", 'he said "you gromp" to me'))
    assert plain[0] > 0 and plain[2] == 0 and quoted[0] == 0 and quoted[2] > 0


def test_edges(spark):
    _, labels, _ = toxic_table(spark)
    assert T.score(edges(spark), labels).count() == len(edge_texts())
    assert T.score(empty(spark), labels).collect() == []
    assert {r["predicted"] for r in T.score(edges(spark), labels.limit(0)).collect()} == {0}

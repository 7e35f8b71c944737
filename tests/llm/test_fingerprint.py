import hashlib
from collections import Counter

import numpy as np
from helpers import documents, edge_texts, edges, empty, prose

from docsift.llm import fingerprint as P


def expected(rows):
    """(doc_id, n_chars, edited digest) by the rules, in order of descending ids, ties by text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, (r[1] or "").encode()))
    texts = [t or "" for _, t in order]
    out = []
    for k, (i, _) in enumerate(order):
        text, other = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        new = text[:len(text) - half] + other[:half]
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=str)


def similarity(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_edited_texts(spark):
    for rows in (edge_texts(), [(i, prose(i, 5 + i)) for i in range(60)], [(1, "only one")]):
        got = P.fingerprints(documents(spark, rows).repartition(5)).select("doc_id", "n_chars", "edited_sha256").collect()
        assert sorted(map(tuple, got), key=str) == expected(rows)
    assert P.fingerprints(empty(spark)).collect() == []


def test_equal_texts_have_equal_fingerprints(spark):
    by_text = {}
    texts = dict(edge_texts())
    for r in P.fingerprints(edges(spark)).collect():
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] in (1, 2):
            by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert [len(v) for v in by_text.values()] == [1]


def test_likeness_estimates_the_weighted_similarity():
    errors = []
    for seed in range(60):
        a = prose(seed, 200, 150)
        b = P.edited(a, prose(seed + 500, 200, 150)) + " " + a[:seed * 10]
        x, y = P.signatures([a, b])
        errors.append(P.likeness(x, y) - similarity(a, b))
    assert abs(np.mean(errors)) < 0.025 and np.std(errors) < 0.085


def test_texts_without_words():
    blank, empty_text, word = P.signatures([" \n", "", "word"])
    assert P.likeness(blank, empty_text) == 1 and P.likeness(blank, word) == 0

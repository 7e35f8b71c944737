"""Tokens, term counts, wildcards and edit distance against plain Python."""

import itertools
import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from docsift.functions.text import (TOKEN_RE, auto_edits, term_counts, tokens, wildcard_regex,
                                    within_edits)

TEXTS = ["John.Doe said: don't! x_1 3.14", "", "  ", "a a b", "Éa éA ñ", "- . '", "zz y y zz zz", None]


def test_tokens_and_counts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for r in df.select("t", tokens(F.col("t")).alias("w"), term_counts(tokens(F.col("t"))).alias("c")).collect():
        if r["t"] is None:
            assert r["w"] is None and r["c"] is None
            continue
        want = regex.findall(TOKEN_RE, r["t"].lower())
        assert r["w"] == want
        assert [(c["term"], c["tf"]) for c in r["c"]] == sorted(Counter(want).items())


@pytest.mark.parametrize("pattern,text,hit", [
    ("an*", "anna", True), ("an*", "xanna", False), ("a?c", "abc", True), ("a?c", "ac", False),
    ("a\\*c", "a*c", True), ("a\\*c", "abc", False), ("*", "", True), ("a.c", "abc", False),
    ("a*c", "a\nc", True), ("[ab]", "a", False), ("end\\", "end\\", True)])
def test_wildcards(spark, pattern, text, hit):
    got = spark.range(1).select(F.lit(text).rlike(wildcard_regex(pattern))).first()[0]
    assert got is hit


def alignment_distance(a, b):
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if i == 0 or j == 0}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_edits(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(3000)})
    df = spark.createDataFrame([(w,) for w in words], "w string").cache()
    for term in ["ab", "abc", "aabb", "abcab", "abcabc", "aacbbca", "cabacb", "abababab"]:
        got = {r["w"] for r in df.filter(within_edits(F.col("w"), term)).collect()}
        k = auto_edits(term)
        assert got == {w for w in words if alignment_distance(w, term) <= k}, term
    with pytest.raises(ValueError):
        within_edits(F.col("w"), "abcdef", 3)

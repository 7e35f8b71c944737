"""Ranking against straightforward Python."""

import math
import random
from collections import Counter

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from docsift.operators import relevance
from docsift.operators.relevance import Clause
from docsift.plans.predicates import Q
from docsift.schema import DEFAULT_MAPPING


def corpus(seed, size, hot=True):
    """Texts in which one word is in a third of all rows and a few are everywhere."""
    rng, out = random.Random(seed), []
    for _ in range(size):
        words = [f"w{min(rng.randint(0, 60), rng.randint(0, 60))}" for _ in range(rng.randint(0, 25))]
        if hot and rng.random() < 0.34:
            words += ["hot"] * rng.randint(1, 3)
        out.append(" ".join(words + ["the"] * rng.randint(0, 2)))
    return out


class Bm25:
    def __init__(self, texts):
        self.docs = [Counter(t.lower().split()) for t in texts]
        self.lengths = [sum(d.values()) for d in self.docs]
        self.n = sum(1 for x in self.lengths if x)
        self.avg = sum(self.lengths) / self.n
        self.df = Counter(w for d in self.docs for w in d)

    def idf(self, w):
        return math.log(1 + (self.n - self.df[w] + 0.5) / (self.df[w] + 0.5))

    def part(self, i, w):
        tf = self.docs[i][w]
        return tf / (tf + 1.2 * (0.25 + 0.75 * self.lengths[i] / self.avg)) if tf else 0.0

    def score(self, i, query):
        return sum(n * self.idf(w) * self.part(i, w)
                   for w, n in Counter(query.lower().split()).items() if self.docs[i][w])

    def picked(self, text):
        rank = [(-round(n * (math.log((self.n + 1) / (self.df[w] + 1)) + 1), 9), w)
                for w, n in Counter(text.split()).items() if self.df[w]]
        return [w for _, w in sorted(rank)[:25]]

    def similar(self, i, text):
        """None, or the score of a document similar enough."""
        terms = self.picked(text)
        hit = [w for w in terms if self.docs[i][w]]
        if not hit or len(hit) < max(1, len(terms) * 70 // 100):
            return None
        return sum(self.idf(w) * self.part(i, w) for w in hit)


@pytest.fixture(scope="module")
def texts():
    return corpus(5, 300)


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, "even" if i % 2 == 0 else "odd", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, type string, text string").cache()


def scores(df):
    return {r["id"]: pytest.approx(r["score"], abs=1e-9) for r in df.select("id", "score").collect()}


def test_search(docs, texts):
    model, query = Bm25(texts), "W1 hot hot w59 nosuch"
    want = {i: model.score(i, query) for i in range(len(texts)) if model.score(i, query) > 0}
    assert scores(relevance.bm25_search(docs, "text", query)) == want
    odd = relevance.bm25_search(docs, "text", query, "odd", Q.range("id", 50, "*"))
    assert scores(odd) == {i: s for i, s in want.items() if i % 2 and i >= 50}
    assert scores(relevance.bm25_search(docs, "text", "nosuch")) == {}
    assert scores(relevance.bm25_search(docs, "text", "...")) == {}


def test_boosts(docs, texts):
    model = Bm25(texts)
    got = relevance.search(docs, [Clause("text", "w3 w4", 2.0), Clause("text", "hot", 0.5)])
    want = {i: 2 * model.score(i, "w3 w4") + 0.5 * model.score(i, "hot") for i in range(len(texts))}
    assert scores(got) == {i: s for i, s in want.items() if s > 0}


def test_two_fields(spark, texts):
    rows = [(i, texts[i], texts[-i]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    one, two = Bm25([r[1] for r in rows]), Bm25([r[2] for r in rows])
    got = relevance.search(df, [Clause("a", "w1"), Clause("b", "w2", 3.0)])
    want = {i: one.score(i, "w1") + 3 * two.score(i, "w2") for i in range(100)}
    assert scores(got) == {i: s for i, s in want.items() if s > 0}
    # each field selects its own words and the share is taken over all of them
    like = "w1 w2 w3 hot"
    got = {r["id"] for r in relevance.find_similar(df, None, None, ["a", "b"], like).collect()}
    picks = [(m, w) for m in (one, two) for w in m.picked(like)]
    assert got == {i for i in range(100)
                   if sum(1 for m, w in picks if m.docs[i][w]) >= max(1, len(picks) * 70 // 100)}


def test_nested_mean(spark, texts):
    rows = [(i, [(t,) for t in texts[i * 3:i * 3 + 3]]) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, nstd array<struct<text: string>>")
    model, want = Bm25(texts[:150]), {}
    for i in range(50):
        parts = [s for s in (model.score(j, "hot w7") for j in range(i * 3, i * 3 + 3)) if s > 0]
        if parts:
            want[i] = sum(parts) / len(parts)
    assert scores(relevance.search_nested(df, "nstd", "text", "hot w7")) == want


def test_similar(docs, texts):
    model = Bm25(texts)
    for like in (texts[8], "w1 w2", "hot the w3 w3 zzz"):
        want = {i: model.similar(i, like) for i in range(len(texts)) if i != 8}
        got = relevance.find_similar(docs, None, "8", ["text"], like, DEFAULT_MAPPING)
        assert scores(got) == {i: s for i, s in want.items() if s is not None}
    by_default = relevance.find_similar(docs, None, "8", None, texts[8])
    assert scores(by_default).keys() == scores(
        relevance.find_similar(docs, None, "8", ["text"], texts[8])).keys()
    assert relevance.find_similar(docs, None, None, ["text"], "zzz").count() == 0


def ranked(df):
    return {(r["query_id"], r["rank"]): (r["doc_id"], pytest.approx(r["score"], abs=1e-6))
            for r in df.collect()}


def best(want, k):
    order = sorted((-round(s, 6), i) for i, s in want.items())
    return [(i, round(-s, 6)) for s, i in order[:k]]


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_batches(spark, docs, texts, hot_rows):
    """One query in three is the same text, and the hot words are in a third of all rows or more."""
    model = Bm25(texts)
    asked = corpus(9, 20) + ["hot the"] * 11 + ["", "nosuch", "the", "w60 hot"]
    queries = spark.createDataFrame(list(enumerate(asked)), "q long, t string")
    index = relevance.term_index(docs, "id", "text").cache()
    got = ranked(relevance.bm25_batch(index, queries, "q", "t", 4, hot_rows))
    want = {}
    for q, text in enumerate(asked):
        hits = {i: model.score(i, text) for i in range(len(texts))}
        for rank, hit in enumerate(best({i: s for i, s in hits.items() if s > 0}, 4), 1):
            want[q, rank] = hit
    assert got == want
    got = ranked(relevance.find_similar_batch(index, queries, "q", "t", 4, hot_rows=hot_rows))
    want = {}
    for q, text in enumerate(asked):
        hits = {i: model.similar(i, text) for i in range(len(texts))}
        for rank, hit in enumerate(best({i: s for i, s in hits.items() if s is not None}, 4), 1):
            want[q, rank] = hit
    assert got == want


def test_similar_to_itself_is_left_out(spark, docs):
    index = relevance.term_index(docs, "id", "text")
    queries = docs.filter("id < 10")
    rows = relevance.find_similar_batch(index, queries, "id", "text", exclude_same_id=True).collect()
    assert rows and all(r["query_id"] != r["doc_id"] for r in rows)


def test_stored_words(spark, docs):
    """An array column of words gives the same ranking as the text."""
    words = docs.withColumn("words", F.split(F.lower("text"), " ")).drop("text")
    words = words.withColumn("words", F.filter("words", lambda w: w != ""))
    a = relevance.bm25_search(docs, "text", "hot w2").orderBy(F.desc("score"), "id")
    b = relevance.bm25_search(words, "words", "hot w2").orderBy(F.desc("score"), "id")
    assert in_order(a) == in_order(b)


def test_a_scored_tree_is_tested_once(spark):
    """Objects are analysed where they are scored, once for all terms, and the tree is not tested again."""
    docs = spark.createDataFrame([(1, "en", "red fox\nred hen"), (2, "en", "blue"), (3, "de", "fox fox red")], "id long, lang string, text string")
    docs = docs.select("id", "lang", F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text"))).alias("nstd"))
    inner = Q.nested(Q.match("text", "red fox hen cow"))
    hits = relevance.score_query(docs, Q.bool(must=[inner], should=[Q.term("id", 1)]))
    one = relevance.score_query(docs, inner)
    scores, plain = ({r["id"]: r["score"] for r in df.collect()} for df in (hits, one))
    assert set(scores) == set(plain) and all(abs(scores[i] - plain[i] - (i == 1)) < 1e-12 for i in plain)
    texts = [df._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") for df in (hits, one)]
    assert texts[0] == texts[1]

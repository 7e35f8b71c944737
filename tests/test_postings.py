"""The stored term index against the ranking by documents."""

import random

import pytest
from pyspark.sql import functions as F

from docsift.operators import postings as P
from docsift.operators import relevance as R
from docsift.session import scratch_path


def texts(seed, n, longest):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, longest)))) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = texts(1, 400, 40) + [(1000, None), (1001, ""), (1002, "!!"), (1003, "w0 " * 500)] + [(2000 + i, "w1 w2 w40") for i in range(50)]
    return spark.createDataFrame(rows, "id long, text string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(texts(2, 12, 9) + [(50, None), (51, ""), (52, "nowhere"), (53, "w0 w0 w0"), (54, "w1 w2 w40")],
                                 "q long, asked string")


def rows(df):
    return sorted(map(tuple, df.select("query_id", "doc_id", "score", "rank").collect()))


@pytest.mark.parametrize("range_docs", [1, 8, 1000])
def test_same_as_by_documents(spark, docs, queries, range_docs, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_POSTINGS", 500)
    index = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=range_docs)
    assert index.buckets > 1
    by_document = R.term_index(docs, "id", "text")
    assert rows(P.bm25_batch(index, queries, "q", "asked", 5)) == rows(R.bm25_batch(by_document, queries, "q", "asked", 5))
    assert rows(P.find_similar_batch(index, queries, "q", "asked", 5, max_terms=4)) == rows(
        R.find_similar_batch(by_document, queries, "q", "asked", 5, max_terms=4))


def test_hot_terms_are_cut(spark, docs, queries):
    index = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=4)
    assert rows(P.bm25_batch(index, queries, "q", "asked", 3, hot_rows=5)) == rows(P.bm25_batch(index, queries, "q", "asked", 3))


def test_ranges_below_the_floor_stay_closed(spark, monkeypatch):
    """Many long documents with one common word, a few short ones: the long ones cannot reach the top."""
    monkeypatch.setattr(P, "SEED_RANGES", 1)
    docs = spark.createDataFrame([(i, "w " + "x " * 200) for i in range(300)] + [(1000 + i, "w w w") for i in range(8)],
                                 "id long, text string")
    index = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=8)
    opened, seen = P.Postings.opened, []
    monkeypatch.setattr(P.Postings, "opened", lambda self, pairs, *a: seen.append(pairs.count()) or opened(self, pairs, *a))
    found = P.bm25_batch(index, spark.createDataFrame([(1, "w")], "q long, asked string"), "q", "asked", 5).collect()
    assert {r["doc_id"] for r in found} <= set(range(1000, 1008)) and len(found) == 5
    assert seen == [1, 1]


def test_only_the_buckets_of_the_terms_are_read(spark, docs, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_POSTINGS", 200)
    index = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"))
    again = P.Postings.open(spark, index.path)
    assert again == index and index.buckets >= 16
    asked, near = again.asked(spark.createDataFrame([(1, "w7")], "q long, asked string"), "q", "asked")
    assert len(near) == 1 and asked.first()["df"] == docs.filter(F.col("text").rlike(r"\bw7\b")).count()
    blocks = again._table("blocks", near)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket")
    heads = again.blocks(asked, near, "top")
    assert "docs" not in heads._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_empty(spark, queries):
    none = spark.createDataFrame([(1, None)], "id long, text string")
    index = P.store_postings(none, "id", "text", scratch_path(spark, "postings"))
    assert rows(P.bm25_batch(index, queries, "q", "asked")) == []
    assert rows(P.find_similar_batch(index, queries, "q", "asked")) == []


def test_blocks_are_made_where_their_documents_lie(spark, docs, monkeypatch):
    """Documents go to their ranges with their words counted: no shuffle has a row per posting."""
    plans = []
    hint = type(docs).hint
    monkeypatch.setattr(type(docs), "hint", lambda self, *a: plans.append(
        self._jdf.queryExecution().executedPlan().toString()) or hint(self, *a))
    path = scratch_path(spark, "postings")
    P.store_postings(docs, "id", "text", path, range_docs=8)
    assert plans and "hashpartitioning(term" not in plans[0]  # words are taken apart behind the only shuffle
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.filter("size(ids) <> m OR size(tfs) <> m OR size(lengths) <> m").isEmpty()
    found = blocks.select("term", F.inline(F.arrays_zip("ids", "tfs", "lengths")))
    wanted = R.term_index(docs, "id", "text").select(F.col("doc_id").alias("ids"), F.inline("terms"), F.col("length").alias("lengths"))
    assert sorted(map(tuple, found.select("ids", "term", "tfs", "lengths").collect())) == sorted(
        map(tuple, wanted.select("ids", "term", "tf", "lengths").collect()))


def test_a_large_index_is_written_in_parts(spark, docs, queries, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_POSTINGS", 500)
    whole = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=8)
    monkeypatch.setattr(P, "PART_POSTINGS", 1500)
    given, hint = [], type(docs).hint
    monkeypatch.setattr(type(docs), "hint", lambda self, *a: given.append(self) or hint(self, *a))
    parted = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=8)
    assert len(given) > 3 and parted.buckets == whole.buckets  # the last one makes the dictionary
    kept = [sorted((r["term"], r["rng"], r["top"], r["m"], sorted(zip(r["ids"], r["tfs"], r["lengths"])), r["bucket"])
                   for r in spark.read.parquet(f"{index.path}/blocks").collect()) for index in (whole, parted)]
    assert kept[0] == kept[1] and kept[0]
    dictionary = [sorted(map(tuple, spark.read.parquet(f"{index.path}/terms").collect())) for index in (whole, parted)]
    assert dictionary[0] == dictionary[1]
    assert rows(P.bm25_batch(parted, queries, "q", "asked", 5)) == rows(P.bm25_batch(whole, queries, "q", "asked", 5))


def test_a_block_travels_once_for_all_queries(spark, docs, queries, monkeypatch):
    index = P.store_postings(docs, "id", "text", scratch_path(spark, "postings"), range_docs=8)
    wanted = rows(P.bm25_batch(index, queries, "q", "asked", 5))
    asked, near = index.asked(queries, "q", "asked")
    asked = asked.select("query_id", "term", "blocks", F.lit(1.0).alias("w"))
    pairs = index.heads(asked, near, 1000).select("query_id", "rng")
    plan = index.opened(pairs, asked, near, 1000)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(rng" in plan and "hashpartitioning(query_id" not in plan
    monkeypatch.setattr(P, "TASK_QUERIES", 3)
    assert rows(P.bm25_batch(index, queries, "q", "asked", 5)) == wanted

"""A stored term index: postings by term, in blocks with their highest score.

Documents of like lengths are dealt to ranges of a few hundred. A block is what one term has in one range: the documents, their
lengths and how often each has the term, in arrays of plain numbers, and the most that any of them adds to a score. A table of queries is answered from the heads of the
blocks first: they bound what a range can give to a query, and only blocks of ranges that can still reach the best k are
opened. The answer is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.functions.text import term_counts, tokens, wildcard_regex, within_edits
from docsift.operators.relevance import _idf, _pick_weight, _required, _tf_part, _top, term_index
from docsift.plans.skew import BROADCAST_BYTES, salted_join
from docsift.schema import DEFAULT_MAPPING, FieldMapping
from docsift.session import Scratch, materialize, release, stored_bytes

# Documents in a range, on average.
RANGE_DOCS = 256
# Postings in a bucket of terms, on average.
BUCKET_POSTINGS = 250_000
# Postings in a task that makes the blocks of its ranges, on average.
TASK_POSTINGS = 1_000_000
# Postings that are dealt out in one go, on average, while the shuffle files of the others don't exist, and the most such parts.
PART_POSTINGS, PARTS = 1_000_000, 6
# Queries, on average, for which a block travels once.
TASK_QUERIES = 1_000
# Ranges per query that are scored first to find out what an answer must reach.
SEED_RANGES = 2
STATS = "n bigint, avg double, buckets int, id_type string"


@dataclass(frozen=True)
class Postings:
    """`<path>/blocks/bucket=<b>/` (term, rng, top, m, ids, tfs, lengths), `<path>/terms/bucket=<b>/` (term, df, blocks), `<path>/stats`.

    The bucket of a term is its hash; within a bucket blocks are sorted by term, so that a few terms are found
    by the statistics of the files.
    """

    spark: SparkSession
    path: str
    n: int
    avg: float
    buckets: int
    id_type: str

    @staticmethod
    def open(spark: SparkSession, path: str) -> "Postings":
        row = spark.read.schema(STATS).parquet(f"{path}/stats").first()
        return Postings(spark, path, row["n"], row["avg"], row["buckets"], row["id_type"])

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _table(self, name: str, wanted: list[int] | None = None) -> DataFrame:
        """A table, or some buckets of it: the others are not opened."""
        kinds = {"blocks": f"term string, rng bigint, top double, m int, ids array<{self.id_type}>, tfs array<int>, lengths array<int>",
                 "terms": "term string, df bigint, blocks bigint"}
        rows = self.spark.read.schema(f"{kinds[name]}, bucket int").parquet(f"{self.path}/{name}")
        return (rows if wanted is None else rows.filter(F.col("bucket").isin(wanted))).drop("bucket")

    def dictionary(self, pattern: Callable[[Column], Column]) -> DataFrame:
        """`(term, df)` of the distinct terms that pass a test: each is tested once, in however many documents it stands."""
        return self._table("terms").filter(pattern(F.col("term"))).select("term", "df")

    def documents(self, pattern: Callable[[Column], Column]) -> DataFrame:
        """`(doc_id)` of the documents with a term that passes a test, each once. Only the blocks of these terms are opened."""
        terms = materialize(self.dictionary(pattern), "matches")
        near = sorted(r[0] for r in terms.select(self._bucket(F.col("term"))).distinct().collect())
        return self.blocks(terms, near, "ids").select(F.explode("ids").alias("doc_id")).distinct()

    def with_prefix(self, prefix: str) -> DataFrame:
        """Documents with a word that begins so; a bucket is sorted by term, so its statistics leave most of it out."""
        return self.documents(lambda term: term.startswith(prefix))

    def with_wildcard(self, pattern: str) -> DataFrame:
        """Documents with a word that fits a pattern of `*` and `?`, which may also begin with one."""
        return self.documents(lambda term: term.rlike(wildcard_regex(pattern)))

    def with_typos(self, word: str) -> DataFrame:
        """Documents with a word within the edits that the length of `word` allows."""
        return self.documents(lambda term: within_edits(term, word))

    def blocks(self, asked: DataFrame, near: list[int], *columns: str) -> DataFrame:
        """The blocks of the asked terms. The others are left out where they are read, as long as the terms fit a broadcast."""
        terms = materialize(asked.select("term").distinct(), "terms")
        if stored_bytes(terms) <= BROADCAST_BYTES:
            terms = F.broadcast(terms)
        return self._table("blocks", near).select("term", "rng", *columns).join(terms, "term", "left_semi")

    def asked(self, queries: DataFrame, id: str, text: str) -> tuple[DataFrame, list[int]]:
        """`(query_id, term, tf, df, blocks)` of the known words of the queries, and their buckets."""
        words = materialize(queries.select(F.col(id).alias("query_id"), F.inline(term_counts(tokens(F.col(text))))), "words")
        near = sorted(r[0] for r in words.select(self._bucket(F.col("term"))).distinct().collect())
        found = salted_join(words, self._table("terms", near), ["term"], "query_id", "term", right_unique=True)
        return found, near

    def heads(self, asked: DataFrame, near: list[int], hot_rows: int) -> DataFrame:
        """`(query_id, rng, most, terms)`: what a range can give to a query at most, and how many of the query's terms
        it has. No block is opened."""
        heads = self.blocks(asked, near, "top")
        counts = asked.groupBy("term").agg(F.first("blocks").alias("_left"), F.count(F.lit(1)).alias("_right"))
        met = salted_join(heads, asked.select("query_id", "term", "w"), ["term"], "rng", "query_id", hot_rows, counts)
        return met.groupBy("query_id", "rng").agg(F.sum(F.col("w") * F.col("top")).alias("most"),
                                                  F.count(F.lit(1)).alias("terms"))

    def opened(self, pairs: DataFrame, asked: DataFrame, near: list[int], hot_rows: int) -> DataFrame:
        """`(query_id, doc_id, matched, score)` of all documents in the given pairs of a query and a range.

        A block travels to its range as a whole and once for all queries that ask for it (`TASK_QUERIES` of them), and is
        taken apart there, so a shuffled row stands for all documents of a block, and what is added up per document is
        not shuffled again.
        """
        wanted = materialize(salted_join(
            pairs.select("query_id", "rng"), asked.groupBy("query_id").agg(F.collect_list(F.struct("term", "w")).alias("asked")),
            ["query_id"], "rng", "query_id", hot_rows, right_unique=True).select("query_id", "rng", F.inline("asked")), "wanted")
        parts = max(1, math.ceil(asked.select("query_id").distinct().count() / TASK_QUERIES))
        by = wanted.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts))).repartition("term", "rng").groupBy(
            "term", "rng", "part").agg(F.collect_list(F.struct("query_id", "w")).alias("by"))
        arrays = ["ids", "tfs", "lengths"]
        met = self.blocks(wanted, near, *arrays).join(by, ["term", "rng"]).select("rng", "part", "by", *arrays)
        adds = _tf_part(F.col("tfs").cast("double"), F.col("lengths").cast("double"), F.lit(self.avg))
        return (met.repartition("rng", "part").select("rng", "part", F.inline("by"), *arrays)
                .select("rng", "part", "query_id", "w", F.inline(F.arrays_zip(*arrays)))
                .withColumnRenamed("ids", "doc_id").groupBy("rng", "part", "query_id", "doc_id").agg(
                    F.count(F.lit(1)).alias("matched"), F.sum(F.col("w") * adds).alias("score")).drop("rng", "part"))


def store_postings(docs: DataFrame, id: str, text: str, path: str, mapping: FieldMapping = DEFAULT_MAPPING,
                   range_docs: int = RANGE_DOCS) -> Postings:
    """Write the term index of a text field. Documents are shuffled to their ranges with their words counted, and taken apart
    there, so that only whole blocks travel on; a word of every document has a block in each range. A document without words
    is in no range.

    A large index is written in parts, each with the terms of some buckets, and the shuffle files of a part are given back
    before the next one begins."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "postings")
    length_class = F.floor(F.log2("length") * 2).cast("int")
    index = scratch.write(term_index(docs, id, text, mapping).withColumn("class", length_class), "index")
    size = index.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg"), F.sum(F.size("terms")).alias("m")).first()
    n, avg = size["n"], size["avg"] or 1.0
    buckets = 1
    while buckets * BUCKET_POSTINGS < (size["m"] or 0):
        buckets *= 2
    # two classes for each doubling of the length: a few dozen rows
    classes = index.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / range_docs).alias("parts"))
    rng = F.shiftleft(F.col("class").cast("long"), 48) + F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    adds = _tf_part(F.col("tf").cast("double"), F.col("length").cast("double"), F.lit(avg))
    tasks = max(1, math.ceil((size["m"] or 0) / TASK_POSTINGS))

    def bucket(term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")

    parts = max(1, min(PARTS, buckets, math.ceil((size["m"] or 0) / PART_POSTINGS)))
    for part in range(parts):
        rows = index if parts == 1 else index.withColumn("terms", F.filter(
            "terms", lambda t: bucket(t["term"]) % parts == part))  # noqa: B023
        # words and counts in arrays of their own: an array of structs takes twice the room in a shuffle
        dealt = (rows.join(F.broadcast(classes), "class")
                 .select("doc_id", "length", rng.alias("rng"), F.col("terms.term").alias("term"),
                         F.col("terms.tf").cast("array<int>").alias("tf")).repartition(tasks, "rng"))
        postings = dealt.select("doc_id", "length", "rng", F.inline(F.arrays_zip("term", "tf")))
        blocks = (postings.groupBy("term", "rng").agg(F.max(adds).alias("top"), F.count(F.lit(1)).cast("int").alias("m"),
                                                      F.collect_list(F.struct("doc_id", "tf", "length")).alias("docs"))
                  .select("term", "rng", "top", "m", F.col("docs.doc_id").alias("ids"), F.col("docs.tf").alias("tfs"),
                          F.col("docs.length").alias("lengths"), bucket(F.col("term")).alias("bucket")))
        (blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "rng")
         .write.mode("append").partitionBy("bucket").parquet(f"{path}/blocks"))
        if parts > 1:
            release(spark)
    scratch.drop()
    stored = spark.read.schema("term string, m int, bucket int").parquet(f"{path}/blocks")
    terms = stored.groupBy("bucket", "term").agg(
        F.sum("m").alias("df"), F.count(F.lit(1)).alias("blocks"))
    (terms.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
     .write.partitionBy("bucket").parquet(f"{path}/terms"))
    if parts > 1:
        release(spark)
    id_type = index.schema["doc_id"].dataType.simpleString()
    spark.createDataFrame([(n, avg, buckets, id_type)], STATS).coalesce(1).write.parquet(f"{path}/stats")
    return Postings(spark, path, n, avg, buckets, id_type)


def bm25_batch(index: Postings, queries: DataFrame, id: str, text: str, k: int = 10,
               hot_rows: int = 1_000_000) -> DataFrame:
    """For each row of `queries` the k best documents: `query_id, doc_id, score, rank`, as `relevance.bm25_batch` gives.

    The ranges that promise most are scored first. The k-th score found there is a floor for the answer: the blocks of
    ranges that promise less are not opened.
    """
    found, near = index.asked(queries, id, text)
    asked = materialize(found.select("query_id", "term", "blocks", (
        F.col("tf") * _idf(F.lit(index.n), F.col("df"))).alias("w")), "asked")
    heads = materialize(index.heads(asked, near, hot_rows), "heads")
    order = Window.partitionBy("query_id").orderBy(F.col("most").desc(), "rng")
    first = heads.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SEED_RANGES)
    floor = materialize(_top(index.opened(first, asked, near, hot_rows), k).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("found"), F.min("score").alias("low")).filter(F.col("found") >= k)
        .select("query_id", (F.col("low") - 1e-5).alias("low")), "floor")
    able = heads.join(floor, "query_id", "left").filter(F.col("low").isNull() | (F.col("most") >= F.col("low")))
    return _top(index.opened(able, asked, near, hot_rows), k).select("query_id", "doc_id", "score", "rank")


def find_similar_batch(index: Postings, queries: DataFrame, id: str, text: str, k: int = 10,
                       exclude_same_id: bool = False, hot_rows: int = 1_000_000,
                       max_terms: int | None = None) -> DataFrame:
    """For each row of `queries` the k most similar documents, as `relevance.find_similar_batch` gives.

    A document must have `need` of the selected terms, so a range with fewer of them is not opened.
    """
    found, near = index.asked(queries, id, text)
    n, df = F.lit(index.n), F.col("df")
    asked = found.select("query_id", "term", "blocks", _idf(n, df).alias("w"), (-_pick_weight(F.col("tf"), n, df)).alias("r"))
    if max_terms is not None:
        asked = asked.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("r", "term"))).filter(
            F.col("place") <= max_terms)
    asked = materialize(asked.select("query_id", "term", "blocks", "w"), "asked")
    need = materialize(asked.groupBy("query_id").agg(_required(F.count(F.lit(1))).alias("need")), "need")
    able = index.heads(asked, near, hot_rows).join(need, "query_id").filter(F.col("terms") >= F.col("need"))
    scored = index.opened(able, asked, near, hot_rows)
    if exclude_same_id:
        scored = scored.filter(F.col("query_id") != F.col("doc_id"))
    scored = scored.join(need, "query_id").filter(F.col("matched") >= F.col("need"))
    return _top(scored, k).select("query_id", "doc_id", "score", "rank")

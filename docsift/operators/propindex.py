"""A stored index of dynamic properties: searches and sorts by property read sorted columns and no JSON.

`<root>/docs` holds the normalised documents. `<root>/pairs` has a row per word of each property (one row for a
property without words), sorted by key, number and word, so that the bounds of its row groups choose among them.
`<root>/keys` is the dictionary of keys with their words.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions import keys as names
from docsift.functions import text
from docsift.operators.maintain import KEYS
from docsift.plans.paging import Page, take_page
from docsift.plans.predicates import (Bool, Boost, Exists, Fields, Fuzzy, Match, Prefix, Query, Range, Term, Where, Wildcard,
                                      all_of, any_of, condition)
from docsift.schema import DEFAULT_MAPPING, PROPS, FieldMapping

FILE_ROWS = 5_000_000
# Keys that a search names to the scan; if a name stands for more of them, their words are compared instead.
NAMED_KEYS = 500

_LEAVES = (Term, Match, Exists, Range, Prefix, Wildcard, Fuzzy)


@dataclass(frozen=True)
class PropertyIndex:
    """The three tables of one index. `on` are the columns that tell documents apart."""

    docs: DataFrame
    pairs: DataFrame
    keys: DataFrame
    on: tuple[str, ...] = KEYS

    # ------------------------------------------------------------ search

    def find(self, query: Query, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
        """The documents that match, as `condition` on the normalised documents would say.

        All property leaves of the tree are answered by one pass over the pairs they need, which hands back the keys
        of documents; the documents are joined with these, and their own conditions reach their scan. Leaves without
        a field look at the pairs stored with the documents.
        """
        fields, leaves = Fields(self.docs.schema, mapping), []
        plain = self._answered(query, fields, leaves)
        if not leaves:
            return self.docs.filter(condition(self.docs, plain, mapping))
        tests = [self._leaf(leaf) for leaf in leaves]
        flags = [F.max(F.coalesce(exact, F.lit(False))).alias(f"_leaf{i}") for i, (_, exact) in enumerate(tests)]
        hits = (self.pairs.filter(any_of([wide for wide, _ in tests])).groupBy(*self.on).agg(*flags))
        found = self.docs.join(hits, list(self.on), "left")
        return found.filter(condition(found, plain, mapping)).select(*self.docs.columns)

    def _answered(self, query: Query, fields: Fields, leaves: list[Query]) -> Query:
        """The tree with flags of the joined hits in place of its property leaves."""
        if isinstance(query, Bool):
            def all_(parts: Sequence[Query]) -> tuple[Query, ...]:
                return tuple(self._answered(q, fields, leaves) for q in parts)

            return Bool(all_(query.must), all_(query.should), all_(query.must_not), all_(query.filter))
        if isinstance(query, Boost):
            return replace(query, query=self._answered(query.query, fields, leaves))
        named = isinstance(query, _LEAVES) and query.field and fields.is_pair(query.field)
        if not named:
            return query
        leaves.append(query)
        flag = f"_leaf{len(leaves) - 1}"
        return Where(lambda: F.coalesce(F.col(flag), F.lit(False)))

    def _named(self, name: str) -> Column:
        """The stored keys that hold all words of a name; as a list that the scan can use, if there are few."""
        words = text.tokens(F.lit(names.nested_key(name)))
        found = self.keys.filter(text.contains_all(F.col("kt"), words)).select("k").limit(NAMED_KEYS + 1).collect()
        if len(found) > NAMED_KEYS:
            return text.contains_all(text.tokens(F.col("k")), words)
        return F.col("k").isin([r["k"] for r in found]) if found else F.lit(False)

    def _leaf(self, leaf: Query) -> tuple[Column, Column]:
        """What a leaf reads, in bare comparisons for the scan, and its exact test on a row of the pairs."""
        key = self._named(leaf.field)
        if isinstance(leaf, (Term, Match)):
            value = str(leaf.value)
            if value == "*":
                return key, key
            if names.is_digits(value):
                near = key & (F.col("vn") == F.lit(float(value)))
                if int(value) >= 1 << 63:
                    return near, near
                return near, near & F.coalesce(F.col("vl") == F.lit(int(value)), F.lit(True))
            words = text.tokens(F.lit(value))
            some = key & (F.col("word") == F.get(words, 0))
            one = F.size(F.array_distinct(words)) == 1
            return some, some & (one | F.coalesce(text.contains_all(F.col("vt"), words), F.lit(False)))
        if isinstance(leaf, Exists):
            return key, key
        if isinstance(leaf, Range):
            return self._range(leaf, key)
        if names.is_digits(leaf.value):  # numbers have no words
            return F.lit(False), F.lit(False)
        found = key & leaf.test(F.col("word"))
        return found, found

    @staticmethod
    def _range(leaf: Range, key: Column) -> tuple[Column, Column]:
        bounds = [None if b in ("*", None) else str(b) for b in (leaf.low, leaf.high)]
        given = [b for b in bounds if b is not None]
        if not given:
            return key, key

        def between(column: Column, low, high, with_low: bool, with_high: bool) -> Column:
            parts = []
            if low is not None:
                parts.append(column >= low if with_low else column > low)
            if high is not None:
                parts.append(column <= high if with_high else column < high)
            return all_of(parts)

        if not any(names.is_digits(b) for b in given):
            found = key & between(F.col("word"), *bounds, leaf.include_low, leaf.include_high)
            return found, found
        ends = [None if b is None else float(b) for b in bounds]
        exact = between(F.col("vn"), *ends, leaf.include_low, leaf.include_high)
        if all(names.is_digits(b) and int(b) < 1 << 63 for b in given):
            whole = [None if b is None else int(b) for b in bounds]
            exact = F.when(F.col("vl").isNotNull(), between(F.col("vl"), *whole, leaf.include_low, leaf.include_high)
                           ).otherwise(exact)
        # the double of a whole number is never on the wrong side of the double of the bound
        wide = key & between(F.col("vn"), *ends, True, True)
        return wide, wide & exact

    # ------------------------------------------------------------ sort

    def page(self, found: DataFrame, page: Page, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
        """One page of `found` (documents of this index) in an order that may name numeric properties, such as
        `properties.total:desc`. The values come from one pass over the pairs of these keys; with several of them the largest counts
        downwards and the smallest upwards, and documents without any come last. Adds the values as columns `_by0`, ...
        """
        fields, values, order = Fields(self.docs.schema, mapping), [], []
        for part in filter(None, (p.strip() for p in page.sort.split(","))):
            name, _, word = part.partition(":")
            desc = {"asc": False, "desc": True}.get(word.strip(), page.desc)
            if fields.is_pair(name.strip()):
                key, pick = self._named(name.strip()), F.max if desc else F.min
                values.append((key, pick(F.when(key, F.col("vn"))).alias(f"_by{len(values)}")))
                name = f"_by{len(values) - 1}"
            order.append(f"{name.strip()}:{'desc' if desc else 'asc'}")
        if not values:
            return take_page(found, page, mapping)
        wanted = reduce(lambda a, b: a | b, [key for key, _ in values])
        by = (self.pairs.filter(wanted & F.col("vn").isNotNull()).groupBy(*self.on).agg(*[v for _, v in values]))
        return take_page(found.join(by, list(self.on), "left"), replace(page, sort=", ".join(order)), mapping)


def write_index(docs: DataFrame, root: str, on: Sequence[str] = KEYS, file_rows: int = FILE_ROWS,
                group_bytes: int | None = None) -> PropertyIndex:
    """Store normalised documents (see `normalize`, with analysed pairs) and index their properties.

    Documents are written first, so each is flattened once. `on` must tell documents apart; rows with a null in it are
    not met by property searches. A key with very many rows is spread over files by its values and ids.
    """
    root, on = root.rstrip("/"), tuple(on)
    docs.write.parquet(f"{root}/docs")
    stored = docs.sparkSession.read.schema(docs.schema).parquet(f"{root}/docs")
    # the words of a value go along where they are several; one word stands in the row
    pairs = stored.select(*on, F.explode(PROPS).alias("p")).select(
        *on, "p.k", "p.vn", "p.vl", F.array_distinct("p.vt").alias("w")).select(
        *on, "k", "vn", "vl", F.when(F.size("w") > 1, F.col("w")).alias("vt"), F.explode_outer("w").alias("word"))
    size = stored.agg(F.sum(F.aggregate(PROPS, F.lit(0).cast("bigint"), lambda a, p: a + F.greatest(
        F.lit(1), F.size(F.coalesce(p["vt"], F.array().cast("array<string>"))))))).first()[0] or 0
    order = [F.col("k"), F.col("vn"), F.col("word"), F.xxhash64(*on)]
    writer = pairs.repartitionByRange(max(1, math.ceil(size / file_rows)), *order).sortWithinPartitions(*order).write
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(f"{root}/pairs")
    pairs = docs.sparkSession.read.schema(pairs.schema).parquet(f"{root}/pairs")
    pairs.select("k").distinct().sort("k").withColumn("kt", text.tokens(F.col("k"))).write.parquet(f"{root}/keys")
    return open_index(docs.sparkSession, root, on)


def open_index(spark: SparkSession, root: str, on: Sequence[str] = KEYS) -> PropertyIndex:
    """An index that `write_index` has stored."""
    docs, pairs, keys = (spark.read.parquet(f"{root.rstrip('/')}/{part}") for part in ("docs", "pairs", "keys"))
    return PropertyIndex(docs, pairs, keys, tuple(on))

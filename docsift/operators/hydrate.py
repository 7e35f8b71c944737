"""Index hits completed from, and checked against, the system of record."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.operators.maintain import KEYS
from docsift.session import materialize

# Buckets of keys that are compared by digests.
BUCKETS = 4096


def hydrate(hits: DataFrame, db: DataFrame, keys: Sequence[str] = KEYS,
            read_from_index: bool = False) -> DataFrame:
    """Each hit with the values of the system of record, or its own where the record is missing.

    A found record replaces the indexed fields as a whole, nulls included. Columns the hits alone
    have (a score, a rank) are kept.
    """
    if read_from_index:
        return hits
    keys = list(keys)
    shared = [c for c in db.columns if c not in keys]
    # one column per field, so that fields nobody asks for are not read from the records
    record = db.select(*keys, F.lit(True).alias("_found"),
                       *[F.col(f"`{c}`").alias(f"_db_{c}") for c in shared])
    columns = []
    for name in hits.columns:
        if name in keys or name not in shared:
            columns.append(F.col(f"`{name}`"))
        else:
            columns.append(F.when(F.col("_found"), F.col(f"`_db_{name}`"))
                           .otherwise(F.col(f"`{name}`")).alias(name))
    columns += [F.col(f"`_db_{c}`").alias(c) for c in shared if c not in hits.columns]
    # the few records that are hit are picked out first; only they are joined
    return hits.join(record.join(_keys(hits, keys), keys, "left_semi"), keys, "left").select(*columns)


def _keys(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of the hits, stored, so that Spark knows their size when it chooses the join."""
    return materialize(hits.select(*keys).distinct(), "keys")


def orphans(hits: DataFrame, db: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Stored documents that the index still has and the system of record has not."""
    if "stored" in hits.columns:
        hits = hits.filter(F.col("stored"))
    keys = list(keys)
    return hits.join(db.select(*keys).join(_keys(hits, keys), keys, "left_semi"), keys, "left_anti")


def _bucket(keys: Sequence[str]) -> Column:
    """A bucket by the hash of the key; -1 for a key with a null, which equals no other."""
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(null, -1).otherwise(F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS))).cast("int")


def _digest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """By bucket the number of keys and digests that do not depend on their order, with partial results: whatever the
    table holds, a task sends a row per bucket."""
    names = [F.col(k).cast("string") for k in keys]
    mixed = rows.select(_bucket(keys).alias("bucket"), *[F.xxhash64(F.lit(n), *names).alias(f"h{n}") for n in (1, 2)])
    return mixed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"),
                                       F.sum(F.pmod("h1", F.lit(1 << 30))).alias("total"))


def differing_buckets(docs: DataFrame, db: DataFrame, keys: Sequence[str] = KEYS) -> list[int]:
    """The buckets of keys in which two tables do not hold the same keys equally often; at most `BUCKETS` and the one of nulls."""
    one, two = (_digest(rows, keys) for rows in (docs, db))
    same = [F.col(f"one.{c}").eqNullSafe(F.col(f"two.{c}")) for c in ("n", "x1", "x2", "total")]
    both = one.alias("one").join(two.alias("two"), F.col("one.bucket") == F.col("two.bucket"), "full_outer")
    bucket = F.coalesce("one.bucket", "two.bucket")
    return sorted(r[0] for r in both.filter((bucket < 0) | ~reduce(lambda a, b: a & b, same)).select(bucket).collect())


def clean_orphans(docs: DataFrame, db: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The index without its orphans; documents that aren't stored stay.

    Digests by bucket of the keys are compared first. Buckets in which both sides agree are passed on as they
    are; only the rest of both tables is joined.
    """
    keys = list(keys)
    stored = F.coalesce("stored", F.lit(False)) if "stored" in docs.columns else F.lit(True)
    odd = differing_buckets(docs.filter(stored), db, keys)
    if not odd:
        return docs
    inside = _bucket(keys).isin(odd)
    known = db.filter(inside).select(*keys).distinct().withColumn("_known", F.lit(True))
    checked = docs.filter(inside).join(known, keys, "left").filter(F.col("_known").isNotNull() | ~stored)
    return docs.filter(~inside).unionByName(checked.select(*docs.columns))

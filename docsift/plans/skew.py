"""Equality joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.session import materialize, stored_bytes

# Hot keys are told to all tasks up to so many bytes of their table; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024


def key_counts(left: DataFrame, right: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides, `_left` and `_right`, summed up before the shuffle."""
    rows = left.select(*keys, F.lit(1).alias("_left"), F.lit(0).alias("_right"))
    if right is not None:
        rows = rows.unionByName(right.select(*keys, F.lit(0).alias("_left"), F.lit(1).alias("_right")))
    return rows.groupBy(*keys).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))


def hot_keys(counts: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """The keys with more than `hot_rows` rows on a side, with the number of parts on either side: as many as
    leave at most `hot_rows` in each, however large the key or its side. None if there are none.

    The table goes to the shared folder and not through the driver; it has at most one row per `hot_rows`
    rows of the input.
    """
    def parts(rows: str) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.col(rows) / hot_rows).cast("int"))

    hot = counts.select(*keys, parts("_left").alias("_lp"), parts("_right").alias("_rp")).filter(
        (F.col("_lp") > 1) | (F.col("_rp") > 1))
    hot = materialize(hot, "hot")
    return None if hot.isEmpty() else hot


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str,
                right_id: str, hot_rows: int = 1_000_000, counts: DataFrame | None = None,
                right_unique: bool = False) -> DataFrame:
    """Inner join on equal keys, the hot keys of either side cut into parts.

    The keys are counted first, unless `counts` (see `key_counts`) is given. Without a hot key this is a
    plain join. Otherwise a row under a hot key of its own side goes to the part that the hash of its id
    names, and is repeated once for each part of the other side: every pair still meets exactly once,
    and no task gets a whole hot key.
    """
    keys = list(keys)
    if counts is None:
        counts = key_counts(left, None if right_unique else right, keys)
    hot = hot_keys(counts, keys, hot_rows)
    if hot is None:
        return left.join(right, keys)
    cut = F.broadcast(hot) if stored_bytes(hot) <= BROADCAST_BYTES else hot

    def place(side: DataFrame, row_id: str, own: str, other: str) -> DataFrame:
        parts = {p: F.coalesce(F.col(p), F.lit(1)) for p in (own, other)}
        return (side.join(cut, keys, "left")
                .withColumn(own, F.pmod(F.xxhash64(row_id), parts[own]).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), parts[other] - 1))))

    return (place(left, left_id, "_lp", "_rp")
            .join(place(right, right_id, "_rp", "_lp"), [*keys, "_lp", "_rp"]).drop("_lp", "_rp"))

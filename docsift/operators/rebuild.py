"""Building an index anew from the system of record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.maintain import KEYS, unindex
from docsift.operators.normalize import normalize
from docsift.session import materialize
from docsift.sources.versions import VersionedTable


def rebuild_index(db: DataFrame, index: VersionedTable, destination: str | None = None,
                  drop_previous: bool = False,
                  prepare: Callable[[DataFrame], DataFrame] = normalize) -> DataFrame:
    """Normalise all records, write them as a new version, publish it.

    One read-map-write job; its partitions are the batches. `destination` names the version. If it
    exists already, its documents stay beside the new ones unless they have the same key; versions
    never change, so the result is a version of its own. Returns one row: `reindexed`.
    """
    docs = prepare(db)
    if destination is not None and index.exists(destination):
        keys = [c for c in KEYS if c in docs.columns]
        kept = unindex(index.read(destination), docs, keys)
        fresh = docs.withColumn("_fresh", F.lit(True)).unionByName(kept, allowMissingColumns=True)
        staged = materialize(fresh, "rebuild")
        version = index.write(staged.drop("_fresh"))
        index.publish(version, drop_previous)
        return staged.agg(F.count("_fresh").alias("reindexed"))
    version = index.write(docs, destination)
    index.publish(version, drop_previous)
    return index.read(version).agg(F.count(F.lit(1)).alias("reindexed"))

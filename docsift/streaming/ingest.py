"""Continuous indexing with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsift.operators.maintain import KEYS, resolve_ops, upsert
from docsift.streaming.runs import EVERY, Runs


def _start(stream: DataFrame, path: str, checkpoint: str, mode: str,
           interval: str | None) -> StreamingQuery:
    """Each micro-batch replaces the folder of its own number, so a batch that is run again after
    a failure leaves the same rows once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = (stream.writeStream.foreachBatch(write).outputMode(mode)
              .option("checkpointLocation", checkpoint))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def bulk_ingest(ops: DataFrame, path: str, checkpoint: str,
                interval: str | None = None) -> StreamingQuery:
    """Append a stream of puts and deletes to an operation log in micro-batches.

    A batch costs what it holds: the index is not rewritten. `interval` is the flush interval; without
    one, all input that is there is taken and the query ends.
    """
    return _start(ops, path, checkpoint, "append", interval)


def logged_ops(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def live_index(base: DataFrame | None, ops: DataFrame, mode: str = "replace",
               keys: Sequence[str] = KEYS, seq: str = "seq", op: str = "op") -> DataFrame:
    """The index as of now: the published documents with the logged operations on top.

    Logged rows are ordered by their own `seq`, so a late write never covers a newer one; the
    documents of the base are older than any logged operation. Writing the result as a new version
    and starting a new log is the compaction.
    """
    if base is None:
        return resolve_ops(ops, mode, keys, seq, op)
    return upsert(base, ops, mode, keys, seq, op)


def latest_state(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = KEYS,
                 seq: str = "seq", interval: str | None = None, every: int = EVERY) -> StreamingQuery:
    """Keep the last write per key as streaming state and emit the rows that changed.

    The emitted rows are merged as they grow old (see `Runs`): of a key that changed often the last row is left, and the
    number of folders grows with the logarithm of the batches. The state grows with the number of keys: set the state
    store to RocksDB for a large index.
    """
    rest = [c for c in stream.columns if c not in (*keys, seq)]
    state = stream.groupBy(*keys).agg(
        F.max(seq).alias(seq), F.max_by(F.struct(*rest), F.col(seq)).alias("_doc")).select(*keys, seq, "_doc.*")

    def write(batch: DataFrame, number: int) -> None:
        Runs(batch.sparkSession, path, every).add(batch, number, lambda rows: _latest(rows, keys, seq))

    writer = (state.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint))
    return writer.trigger(**({"processingTime": interval} if interval else {"availableNow": True})).start()


def _latest(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in (*keys, seq)]
    latest = rows.groupBy(*keys).agg(F.max(seq).alias(seq),
                                     F.max_by(F.struct(*rest), F.col(seq)).alias("_doc"))
    return latest.select(*keys, seq, "_doc.*")


def changed_state(spark: SparkSession, path: str, keys: Sequence[str] = KEYS,
                  seq: str = "seq") -> DataFrame:
    """The last emitted row of each key."""
    return _latest(Runs(spark, path).read(), keys, seq)

"""From the operation log to the published index.

A log (see `ingest.bulk_ingest`) takes puts, deletes and deletions by terms. The published index keeps for each key the last
operation with its `seq`, deletes included, and the deletions by terms with theirs; so operations may arrive in any order,
before or after a compaction. The commit of a compaction also says which batches it has consumed, so that a batch is
never applied twice, whatever happens between publishing and truncating the log.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docsift.operators.maintain import BROADCAST_BYTES, DELETE, KEYS, PUT
from docsift.plans.predicates import condition, terms_query
from docsift.schema import DEFAULT_MAPPING, FieldMapping
from docsift.session import materialize, stored_bytes
from docsift.sources.buckets import BucketedIndex, Folder, Place, Version, wider

DELETE_TERMS = "delete_terms"
SEQ, OP = "_seq", "_op"

# Deletions by terms: the terms as JSON, and the last `seq` with them. An earlier one removes nothing more.
Markers = dict[str, int]


def latest(ops: DataFrame) -> DataFrame:
    """The last operation of each key, by one aggregation with partial results."""
    rest = [F.col(f"`{c}`") for c in ops.columns if c not in (*KEYS, SEQ)]
    return ops.groupBy(*KEYS).agg(F.max(SEQ).alias(SEQ), F.max_by(F.struct(*rest), F.col(SEQ)).alias("_last")).select(
        *KEYS, SEQ, "_last.*")


def _hits(state: DataFrame, markers: Mapping[str, int], mapping: FieldMapping) -> list[Column]:
    """For each deletion by terms which puts it removes. What is no JSON object, holds no usable term, names a
    field that no document has or compares a number with a word removes nothing: one bad row must not stop the log."""
    out = []
    for terms, seq in sorted(markers.items()):
        try:
            said = json.loads(terms)
            query = terms_query(said, True) if isinstance(said, dict) else None
            hit = None if query is None else condition(state, query, mapping)
        except ValueError:
            continue
        if hit is not None:
            out.append((F.col(OP) == PUT) & (F.col(SEQ) < seq) & F.coalesce(hit, F.lit(False)))
    return out


def with_markers(state: DataFrame, markers: Mapping[str, int], mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """The state after deletions by terms: a put that matches one with a later `seq` becomes a delete. It keeps its own
    `seq`, since a put between the two, should it come late, need not match."""
    hits = _hits(state, markers, mapping)
    if not hits:
        return state
    out = state.withColumn("_gone", reduce(lambda a, b: a | b, hits))
    fields = [c for c in state.columns if c not in (*KEYS, SEQ, OP)]
    return out.select(*KEYS, *[F.when(~F.col("_gone"), F.col(f"`{c}`")).alias(c) for c in fields], SEQ,
                      F.when(F.col("_gone"), DELETE).otherwise(F.col(OP)).alias(OP)).select(*state.columns)


class LoggedIndex:
    """A bucketed index and the log that feeds it.

    Operations have the columns `appid`, `id`, `op` (put, delete or delete_terms), `seq`, for delete_terms `terms` (a JSON
    object of terms that must all match; no key is needed), and any fields of a document. `seq` must order the
    operations of a key, and deletions by terms among all. Puts replace documents as a whole.
    """

    def __init__(self, index: BucketedIndex, log: str, seq: str = "seq", op: str = "op", terms: str = "terms",
                 mapping: FieldMapping = DEFAULT_MAPPING):
        self.index, self.log, self.mapping = index, log.rstrip("/"), mapping
        self.seq, self.op, self.terms = seq, op, terms
        self.spark = index.spark

    # ------------------------------------------------------------ the log

    def _hadoop(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def batches(self) -> list[int]:
        """The batches of the log that are complete, up to the first one that is still being written."""
        fs, root = self._hadoop(self.log)
        if not fs.exists(root):
            return []
        found = sorted(int(n.removeprefix("batch=")) for s in fs.listStatus(root)
                       if (n := s.getPath().getName()).startswith("batch="))
        out = []
        for n in found:
            if not fs.exists(self._hadoop(f"{self.log}/batch={n}/_SUCCESS")[1]):
                break
            out.append(n)
        return out

    def truncate(self, consumed: int) -> None:
        """Remove batches that the published index holds."""
        for n in self.batches():
            if n <= consumed:
                fs, path = self._hadoop(f"{self.log}/batch={n}")
                fs.delete(path, True)

    def _pending(self, version: Version | None) -> list[int]:
        consumed = -1 if version is None else version.notes.get("consumed", -1)
        return [n for n in self.batches() if n > consumed]

    def _operations(self, batches: list[int]) -> tuple[DataFrame, Markers]:
        """The puts and deletes of some batches under their own names, and the deletions by terms."""
        rows = self.spark.read.option("basePath", self.log).option("mergeSchema", "true").parquet(
            *[f"{self.log}/batch={n}" for n in batches]).drop("batch")
        markers: Markers = {}
        if self.terms in rows.columns:
            said = rows.filter((F.col(self.op) == DELETE_TERMS) & F.col(self.terms).isNotNull())
            # one row per distinct set of terms
            markers = {r[0]: r[1] for r in said.groupBy(self.terms).agg(F.max(self.seq)).collect()}
        fields = [c for c in rows.columns if c not in (*KEYS, self.seq, self.op, self.terms)]
        ops = rows.filter(F.col(self.op).isin(PUT, DELETE) & (F.trim("appid") != "") & (F.trim("id") != ""))
        kept = [F.when(F.col(self.op) == PUT, F.col(f"`{c}`")).alias(c) for c in fields]
        return ops.select(*KEYS, *kept, F.col(self.seq).cast("long").alias(SEQ), F.col(self.op).alias(OP)), markers

    @staticmethod
    def _markers(notes: Mapping[str, Any], more: Markers) -> Markers:
        known = dict(notes.get("markers", {}))
        return known | {t: max(s, known.get(t, s)) for t, s in more.items()}

    # ------------------------------------------------------------ compaction

    def compact(self, forget: int | None = None) -> Version | None:
        """Publish the index with all complete batches of the log applied, then truncate the log. Only the buckets
        that hold a key of the log, or a document that a new deletion by terms removes, are written.

        `forget`: no operation with a smaller `seq` will come any more, so deletes and deletions by terms
        before it need not be remembered. Can be called again at any time, also after a crash.
        """
        if self.index.current() is None:
            columns = T.StructType([T.StructField(k, T.StringType()) for k in KEYS]
                                   + [T.StructField(SEQ, T.LongType()), T.StructField(OP, T.StringType())])
            self.index.rebuild(self.spark.createDataFrame([], columns))
        base = self.index.current()
        if self._pending(base):
            base = self._apply(forget)
        self.truncate(base.notes.get("consumed", -1))
        return base

    def _apply(self, forget: int | None) -> Version:
        now: dict[str, Any] = {}

        def look(version: Version) -> None:
            pending = self._pending(version)
            now["consumed"] = max(pending, default=version.notes.get("consumed", -1))
            now["ops"], now["new"] = None, {}
            if pending:
                ops, now["new"] = self._operations(pending)
                now["ops"] = materialize(latest(ops), "operations")
            now["markers"] = self._markers(version.notes, now["new"])

        def touch(version: Version, folders: dict[Place, Folder]) -> DataFrame:
            look(version)
            none = self.spark.createDataFrame([], "appid string, bucket int, _buckets int")
            places = none if now["ops"] is None else self.index.places(now["ops"].select(*KEYS), folders).select(none.columns)
            if not now["new"] or OP not in version.schema.fieldNames():
                return places
            # what the new deletions by terms would change
            return places.unionByName(self.index.matching(
                version, folders, lambda docs: self._matched(docs, now["new"])).select(none.columns))

        def rewrite(old: DataFrame) -> DataFrame:
            ops = old if now["ops"] is None else old.unionByName(now["ops"], allowMissingColumns=True)
            state = with_markers(latest(ops), now["markers"], self.mapping)
            return state if forget is None else state.filter((F.col(OP) == PUT) | (F.col(SEQ) >= forget))

        def schema(known: T.StructType) -> T.StructType:
            return known if now["ops"] is None else wider(known, now["ops"].schema.fields)

        def notes(known: Mapping[str, Any]) -> dict[str, Any]:
            # before anything has been looked at there is nothing to say
            markers = {t: s for t, s in now.get("markers", {}).items() if forget is None or s >= forget}
            return dict(known) | {"consumed": now.get("consumed", known.get("consumed", -1)), "markers": markers}

        return self.index.change(touch, rewrite, schema, notes, looked=True)

    def _matched(self, docs: DataFrame, markers: Markers) -> Column:
        return reduce(lambda a, b: a | b, _hits(docs, markers, self.mapping), F.lit(False))

    # ------------------------------------------------------------ reading

    def read(self) -> DataFrame:
        """The documents as of now: the published ones with the pending batches of the log on top. Documents that the log does
        not name are read in place; they are not shuffled as long as the keys of the log fit a broadcast."""
        version = self.index.current()
        pending = self._pending(version)
        state = None if version is None else self.index.read(version)
        if pending:
            ops, markers = self._operations(pending)
            new = materialize(latest(ops), "operations")
            if state is None:
                state = new
            else:
                keys = new.select(*KEYS)
                if stored_bytes(new) <= BROADCAST_BYTES:
                    keys = F.broadcast(keys)
                met = state.join(keys, list(KEYS), "left_semi").unionByName(new, allowMissingColumns=True)
                state = state.join(keys, list(KEYS), "left_anti").unionByName(latest(met), allowMissingColumns=True)
            known = {} if version is None else version.notes
            state = with_markers(state, self._markers(known, markers), self.mapping)
        if state is None:
            raise ValueError(f"nothing is published in {self.index.root}, and nothing logged in {self.log}")
        return state.filter(F.col(OP) == PUT).drop(SEQ, OP)


def follow(stream: DataFrame, logged: LoggedIndex, checkpoint: str, every: int = 10,
           interval: str | None = None) -> StreamingQuery:
    """Take a stream of operations into the log and compact it after every so many micro-batches: the last state of each
    key, with no more than `every` batches and two versions of the index at a time. The state is the published index itself and
    not the memory of the job; a batch costs what it holds, a compaction the buckets that it touches.

    One such query may write to a log. A micro-batch that runs again after a failure replaces its own folder, or, if it was
    compacted before, is known by its number and left out.
    """
    def take(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{logged.log}/batch={number}")
        if number % every == every - 1:
            logged.compact()
            logged.index.clean(keep=2)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(**trigger).start())

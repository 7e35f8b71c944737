"""Index maintenance: upserts, deletes, tenant removal and the report on a batch.

Each function maps a table to its next state; `sources.versions` writes and publishes it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.dates import FORMATS, parse_date
from docsift.functions.props import properties_json
from docsift.plans.predicates import any_of, condition, terms_query
from docsift.schema import DATE_FIELDS, DEFAULT_MAPPING, PROPS, FieldMapping
from docsift.session import materialize, stored_bytes

KEYS = ("appid", "id")
PUT, DELETE = "put", "delete"

# A reduced batch whose files have at most this many bytes is broadcast, so that the table it changes is not shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024


# ---------------------------------------------------------------- merging structs field by field

def _leaf_paths(schema: T.StructType, whole: frozenset[str], prefix: tuple = ()) -> list[tuple]:
    out: list[tuple] = []
    for f in schema.fields:
        path = (*prefix, f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields and f.name not in whole:
            out += _leaf_paths(f.dataType, whole, path)
        else:
            out.append(path)
    return out


def _at(path: tuple, root: Column | None = None) -> Column:
    col = F.col(f"`{path[0]}`") if root is None else root[path[0]]
    for part in path[1:]:
        col = col[part]
    return col


def _assemble(schema: T.StructType, whole: frozenset[str], leaf: Mapping[tuple, Column],
              prefix: tuple = ()) -> list[Column]:
    """Rebuild nested structs from their leaves; a struct with no leaf set is null."""
    out = []
    for f in schema.fields:
        path = (*prefix, f.name)
        if path in leaf:
            out.append(leaf[path].alias(f.name))
            continue
        inner = [leaf[p] for p in _leaf_paths(f.dataType, whole, path)]
        struct = F.struct(*_assemble(f.dataType, whole, leaf, path))
        out.append(F.when(any_of([c.isNotNull() for c in inner]), struct).alias(f.name))
    return out


# ---------------------------------------------------------------- operation logs

def resolve_ops(ops: DataFrame, mode: str = "replace", keys: Sequence[str] = KEYS, seq: str = "seq",
                op: str = "op", whole: Sequence[str] = ("latlng",),
                keep_tombstones: bool = False) -> DataFrame:
    """The state after a log of puts and deletes, whatever order its rows come in.

    `replace`: the latest put of a key, as a whole. `merge`: for each field the latest non-null
    value put since the last delete; arrays are replaced, structs are merged field by field.
    `seq` must order the operations of one key. Everything is one aggregation with partial
    results on the map side, so a key with a third of all operations shrinks to a row
    per task before the shuffle.
    """
    if mode not in ("merge", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    fields = T.StructType([f for f in ops.schema.fields if f.name not in (*keys, seq, op)])
    put = F.col(op) == PUT
    aggs = [F.max(F.when(put, F.col(seq))).alias("_put"),
            F.max(F.when(F.col(op) == DELETE, F.col(seq))).alias("_del")]
    atomic = frozenset(whole)
    paths = _leaf_paths(fields, atomic) if mode == "merge" else []
    if mode == "replace":
        aggs.append(F.max_by(F.struct(*[F.col(f"`{n}`") for n in fields.fieldNames()]),
                             F.when(put, F.col(seq))).alias("_doc"))
    else:
        for n, path in enumerate(paths):
            value = _at(path)
            aggs.append(F.max_by(F.struct(F.col(seq).alias("s"), value.alias("x")),
                                 F.when(put & value.isNotNull(), F.col(seq))).alias(f"_f{n}"))
    state = ops.groupBy(*keys).agg(*aggs)
    alive = F.col("_put").isNotNull() & (F.col("_del").isNull() | (F.col("_put") > F.col("_del")))
    if mode == "replace":
        columns = [F.when(alive, F.col("_doc")[n]).alias(n) for n in fields.fieldNames()]
    else:
        fresh = {path: F.when(F.col("_del").isNull() | (F.col(f"_f{n}")["s"] > F.col("_del")),
                              F.col(f"_f{n}")["x"]) for n, path in enumerate(paths)}
        columns = _assemble(fields, atomic, fresh)
    if keep_tombstones:
        return state.select(*keys, *columns, alive.alias("_alive"),
                            F.col("_del").isNotNull().alias("_reset"))
    return state.filter(alive).select(*keys, *columns)


def upsert(snapshot: DataFrame, batch: DataFrame, mode: str = "merge",
           keys: Sequence[str] = KEYS, seq: str = "seq", op: str | None = None,
           whole: Sequence[str] = ("latlng",), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The snapshot (one row per key) after a batch of newer rows.

    The batch is first reduced to one row per key and written to the shared folder. If those files are
    small they are broadcast: the snapshot is then read in place, and only new keys are added behind it.
    Otherwise both sides meet in one full outer join on keys that are unique on either side. A smaller
    `broadcast_bytes` asks for the join earlier; nothing larger than `BROADCAST_BYTES` is broadcast.
    """
    if op is None:
        op, batch = "_op", batch.withColumn("_op", F.lit(PUT))
    keys = list(keys)
    change = materialize(resolve_ops(batch, mode, keys, seq, op, whole, keep_tombstones=True), "batch")
    small = stored_bytes(change) <= min(broadcast_bytes, BROADCAST_BYTES)
    names = [c for c in snapshot.columns if c not in keys]
    missing = [c for c in names if c not in change.columns]
    change = change.withColumns({c: F.lit(None).cast(snapshot.schema[c].dataType) for c in missing})
    schema = T.StructType([snapshot.schema[n] for n in names])
    atomic = frozenset(whole)
    packed = change.select(*keys, F.struct(*names, "_alive", "_reset").alias("_c"))
    old = snapshot.select(*keys, F.struct(*names).alias("_o"))
    new, was = F.col("_c"), F.col("_o")

    if mode == "replace":
        merged = [F.when(new.isNull(), was[n]).otherwise(new[n]).alias(n) for n in names]
    else:
        leaf = {}
        for path in _leaf_paths(schema, atomic):
            kept = F.when(F.coalesce(new["_reset"], F.lit(False)), F.lit(None)).otherwise(_at(path, was))
            leaf[path] = F.coalesce(_at(path, new), kept)
        merged = _assemble(schema, atomic, leaf)
    stays = new.isNull() | new["_alive"]

    if not small:
        return (old.join(packed, keys, "full_outer").filter(stays).select(*keys, *merged)
                .select(*snapshot.columns))
    packed = F.broadcast(packed)
    updated = old.join(packed, keys, "left").filter(stays).select(*keys, *merged)
    known = snapshot.select(*keys).join(F.broadcast(change.select(*keys)), keys, "left_semi")
    added = (change.join(F.broadcast(known), keys, "left_anti").filter("_alive")
             .select(*snapshot.columns))
    return updated.select(*snapshot.columns).unionByName(added)


# ---------------------------------------------------------------- deletes

def unindex(docs: DataFrame, gone: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Remove the listed keys; null and unknown keys are harmless."""
    # a null key equals no key, so it needs no treatment of its own
    return docs.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def unindex_terms(docs: DataFrame, terms: Mapping[str, Any] | None, match_all: bool = True,
                  allow_all: bool = False, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """Remove the documents that match. No terms at all means every document and needs
    `allow_all`; terms of which none is usable remove nothing.
    """
    if not terms:
        if not allow_all:
            raise ValueError("no terms: pass allow_all=True to remove every document")
        return docs.filter(F.lit(False))
    query = terms_query(terms, match_all)
    if query is None:
        return docs
    return docs.filter(~F.coalesce(condition(docs, query, mapping), F.lit(False)))


def drop_tenant(docs: DataFrame, appid: str) -> DataFrame:
    """Remove all documents of one tenant; on a table partitioned by `appid` nothing else is read."""
    return docs.filter(~F.col("appid").eqNullSafe(F.lit(appid)))


# ---------------------------------------------------------------- report

def check_batch(batch: DataFrame, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Add `reason`: why a row cannot be indexed, or null."""
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    reason = F.when(F.col("id").isNull() | (F.trim("id") == ""), F.lit("missing id"))
    if "appid" in kinds:
        reason = reason.when(F.col("appid").isNull() | (F.trim("appid") == ""),
                             F.lit("missing appid"))
    for name in DATE_FIELDS:
        if isinstance(kinds.get(name), (T.StringType, T.IntegralType)):
            text = F.col(name).cast("string")
            reason = reason.when(text.isNotNull() & parse_date(text, formats).isNull(),
                                 F.lit(f"bad date in {name}"))
    if isinstance(kinds.get(PROPS), T.StringType):
        reason = reason.when(F.col(PROPS).isNotNull() & properties_json(F.col(PROPS)).isNull(),
                             F.lit("bad properties"))
    return batch.withColumn("reason", reason)


def split_batch(batch: DataFrame, on_error: str = "report",
                formats: Sequence[str] = FORMATS) -> tuple[DataFrame, DataFrame]:
    """`(accepted, rejected)`; the rejected rows carry a `reason`. `on_error="raise"` fails
    as soon as one row is rejected.
    """
    checked = check_batch(batch, formats)
    rejected = checked.filter(F.col("reason").isNotNull())
    if on_error == "raise":
        first = rejected.select("id", "reason").first()
        if first is not None:
            raise ValueError(f"cannot index {first['id']!r}: {first['reason']}")
    return checked.filter(F.col("reason").isNull()).drop("reason"), rejected

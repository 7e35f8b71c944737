"""Turning source rows into index documents, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.dates import FORMATS, parse_date
from docsift.functions.geo import parse_latlng
from docsift.functions.props import depth_of, properties_json, with_flattened
from docsift.plans.once import with_once
from docsift.schema import DATE_FIELDS, DOCID, IGNORED_FIELDS, PROPS, PROPS_JSON


def docid() -> Column:
    """The keyset-paging key: the same for a document in every run."""
    return F.xxhash64(F.col("appid"), F.col("id"))


def normalize(rows: DataFrame, depth: int | None = None, analysed: bool = True,
              formats: Sequence[str] = FORMATS) -> DataFrame:
    """One narrow pass: dates and coordinates parsed, JSON properties flattened, the ignored fields
    dropped and `_docid` added. The JSON as it came is kept in `_properties`.

    Without a `depth` the nesting of the properties is measured first, so nothing is too deep. A stream can't be
    measured; it must name one.
    """
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = {}
    for name in DATE_FIELDS:
        if isinstance(kinds.get(name), (T.StringType, T.IntegralType)):
            out[name] = parse_date(F.col(name).cast("string"), formats)
        elif isinstance(kinds.get(name), T.TimestampNTZType):
            out[name] = F.col(name).cast("timestamp")
    if isinstance(kinds.get("latlng"), T.StringType):
        out["latlng"] = parse_latlng(F.col("latlng"))
    variant = None
    if isinstance(kinds.get(PROPS), T.StringType):
        out[PROPS_JSON], variant = F.col(PROPS), properties_json(F.col(PROPS))
    elif isinstance(kinds.get(PROPS), (T.StructType, T.MapType)):
        out[PROPS_JSON] = F.to_json(F.col(PROPS), {"ignoreNullFields": "false"})
        variant = properties_json(out[PROPS_JSON])
    elif isinstance(kinds.get(PROPS), T.VariantType):
        out[PROPS_JSON], variant = F.to_json(F.col(PROPS)), F.col(PROPS)
    if "appid" in kinds and "id" in kinds:
        out[DOCID] = docid()
    if variant is not None:
        out["_variant"] = variant
    docs = rows.drop(*IGNORED_FIELDS).withColumns(out)
    if variant is None:
        return docs
    if depth is None:
        depth = depth_of(rows, out[PROPS_JSON])
    return with_flattened(docs, PROPS, F.col("_variant"), depth, analysed).drop("_variant")


def property_rows(rows: DataFrame, json: str, keys: Sequence[str],
                  depth: int | None = None) -> DataFrame:
    """One row per flattened property: the key columns with `k`, `v` and `vn`."""
    depth = depth_of(rows, F.col(json)) if depth is None else depth
    pairs = with_flattened(rows.select(*keys, F.col(json).alias("_json")), "_found", properties_json(F.col("_json")), depth,
                           analysed=False)
    # a filter on the pairs must not flatten them a second time
    return with_once(pairs, "_pairs", F.col("_found")).select(*keys, F.inline("_pairs"))


def restore(docs: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """The document as it was indexed: `properties` parsed from the kept JSON (a variant, or
    a struct when a schema is given), helper columns dropped. JSON that does not parse gives null.
    """
    if PROPS_JSON in docs.columns:
        kept = F.col(PROPS_JSON)
        docs = docs.withColumn(PROPS, properties_json(kept) if schema is None
                               else F.from_json(kept, schema))
    return docs.drop(PROPS_JSON, DOCID)

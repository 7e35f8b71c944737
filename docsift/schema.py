"""The document model: system fields, their kinds, and the flattened property pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# System fields that are matched whole, case-sensitive and un-analysed.
KEYWORD_FIELDS = frozenset({
    "id", "key", "name", "type", "tag", "tags", "token", "email", "appid", "groups",
    "password", "parentid", "creatorid", "identifier",
})

# System fields that hold dates.
DATE_FIELDS = ("timestamp", "updated")

# Fields that are never indexed.
IGNORED_FIELDS = (
    "settings", "datatypes", "deviceState", "deviceMetadata", "resourcePermissions",
    "validationConstraints",
)

PROPS = "properties"
PROPS_JSON = "_properties"
NSTD = "nstd"
DOCID = "_docid"

# One flattened property. `kt` and `vt` are the analysed key and value, stored once at
# indexing time so that no query tokenises them again.
PAIR_TYPE = T.StructType([
    T.StructField("k", T.StringType()),
    T.StructField("v", T.StringType()),
    T.StructField("vn", T.DoubleType()),
    T.StructField("kt", T.ArrayType(T.StringType())),
    T.StructField("vt", T.ArrayType(T.StringType())),
])

DOC_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType(), False), T.StructField("appid", T.StringType(), False)]
    + [T.StructField(f, T.StringType()) for f in (
        "key", "name", "type", "tag", "token", "email", "groups", "password", "parentid",
        "creatorid", "identifier")]
    + [
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("updated", T.TimestampType()),
        T.StructField("latlng", T.StructType([
            T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])),
        T.StructField(PROPS, T.ArrayType(PAIR_TYPE)),
        T.StructField(PROPS_JSON, T.StringType()),
        T.StructField(DOCID, T.LongType()),
    ])


@dataclass(frozen=True)
class FieldMapping:
    """Which string columns are keywords; every other string column is analysed text."""

    keywords: frozenset[str] = KEYWORD_FIELDS

    def plus(self, *names: str) -> "FieldMapping":
        return FieldMapping(self.keywords | frozenset(names))

    def is_keyword(self, field: str) -> bool:
        return field in self.keywords


DEFAULT_MAPPING = FieldMapping()

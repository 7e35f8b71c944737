"""Dynamic properties: JSON objects flattened to key/value pairs within the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions.text import tokens

NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def _children(e: Column) -> Column:
    """The nodes below an object or array; null below a scalar."""
    head = F.when(F.trim(e["k"]) == "", F.lit("")).otherwise(F.concat(e["k"], F.lit("-")))
    members = F.map_entries(F.try_variant_get(e["x"], "$", "map<string,variant>"))
    items = F.try_variant_get(e["x"], "$", "array<variant>")
    return F.coalesce(
        F.transform(members, lambda c: F.struct(
            F.concat(head, c["key"]).alias("k"), c["value"].alias("x"), F.lit(True).alias("o"))),
        F.transform(items, lambda c, i: F.struct(
            F.concat(e["k"], F.lit("-"), i.cast("string")).alias("k"), c.alias("x"),
            F.lit(False).alias("o"))),
    )


def _leaves(e: Column, depth: int) -> Column:
    """The scalars at or below a node. A scalar is left alone at its own level, so the work is one
    visit per node, however many levels the expression allows for."""
    own = F.array(F.struct(e["k"].alias("k"), e["x"].alias("x"), e["o"].alias("o")))
    if depth == 0:
        return own
    below = F.flatten(F.transform(_children(e), lambda c: _leaves(c, depth - 1)))
    return F.coalesce(below, own)


def _pair(e: Column, kind: Column) -> Column:
    number = kind.isin(*NUMBERS) | kind.startswith("DECIMAL")
    text = (F.when(number, F.lit(None))
            .when(kind == "VOID", F.lit("null"))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(e["x"]))
            .otherwise(F.try_variant_get(e["x"], "$", "string")))
    return F.struct(e["k"].alias("k"), text.alias("v"),
                    F.when(number, F.try_variant_get(e["x"], "$", "double")).alias("vn"),
                  F.when(kind == "BIGINT", F.try_variant_get(e["x"], "$", "bigint")).alias("vl"))


# Levels that one expression takes apart; deeper properties take several of them, one behind the other.
STEP = 8


# What is no bracket: strings, whose brackets mean nothing, and everything else.
_NO_BRACKETS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"]+'


def nesting(brackets: Column) -> Column:
    """How deep brackets lie within each other."""
    depth = F.aggregate(
        F.split(brackets, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda a, c: F.struct(
            (a["now"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)).alias("now"),
            F.greatest(a["most"], a["now"] + F.when(c.isin("{", "["), 1).otherwise(0)).alias("most")),
        lambda a: a["most"])
    return F.coalesce(depth, F.lit(0))


def _opened(json: Column) -> Column:
    """How many brackets are opened, in strings or not; no nesting is deeper."""
    return F.octet_length(json) - F.octet_length(F.replace(F.replace(json, F.lit("{"), F.lit("")), F.lit("["), F.lit("")))


def depth_of(rows: DataFrame, json: Column) -> int:
    """How deep a table is nested at most, in one pass that reads this column only. Of a document with a few brackets their
    number is enough, as one expression goes that deep anyway. Others are looked into: they differ less in the shape
    of their brackets than in their contents, so each shape is looked into once per task."""
    few = _opened(json) <= STEP
    shapes = rows.select(F.when(few, F.repeat(F.lit("["), _opened(json))).otherwise(
        F.regexp_replace(json, _NO_BRACKETS, "")).alias("shape")).distinct()
    return max(1, shapes.agg(F.max(nesting(F.col("shape"))).alias("depth")).first()["depth"] or 1)


def _members(json: Column) -> Column:
    root = F.try_variant_get(json, "$", "map<string,variant>")
    return F.transform(F.map_entries(root), lambda c: F.struct(
        c["key"].alias("k"), c["value"].alias("x"), F.lit(True).alias("o")))


def _down(nodes: Column, levels: int) -> Column:
    return F.flatten(F.transform(nodes, lambda e: _leaves(e, levels)))


def _pairs(leaves: Column, analysed: bool) -> Column:
    kinds = F.transform(leaves, lambda e: F.struct(
        e.alias("e"), F.schema_of_variant(e["x"]).alias("kind")))
    # at the deepest level an empty container may still stand where the rules leave nothing
    kept = F.filter(kinds, lambda n: (n["e"]["o"] | (n["kind"] != "VOID"))
                    & ~n["kind"].isin("OBJECT<>", "ARRAY<VOID>"))
    pairs = F.transform(kept, lambda n: _pair(n["e"], n["kind"]))
    if analysed:
        pairs = F.transform(pairs, lambda p: F.struct(
            p["k"].alias("k"), p["v"].alias("v"), p["vn"].alias("vn"),
            tokens(p["k"]).alias("kt"), tokens(p["v"]).alias("vt"), p["vl"].alias("vl")))
    else:
        pairs = F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v"), p["vn"].alias("vn")))
    return F.coalesce(pairs, F.array().cast(
        "array<struct<k:string,v:string,vn:double"
        + (",kt:array<string>,vt:array<string>,vl:bigint>>" if analysed else ">>")))


def with_flattened(rows: DataFrame, name: str, json: Column, depth: int, analysed: bool = True) -> DataFrame:
    """Add a column array<struct<k, v, vn[, kt, vt, vl]>> of the properties in a JSON object (a variant).

    Path segments and array indexes are joined by `-`. Numbers go to `vn` as doubles, everything
    else to `v` as text. Analysed pairs also hold the words of key and value, and integers exactly in `vl`. A null
    member becomes the text "null"; a null array item is dropped, as are empty objects and arrays. What is not a
    JSON object gives an empty array. The work stays inside the row: no explode, no shuffle.

    `depth` is the deepest nesting (see `depth_of`); whatever lies deeper is kept whole, as JSON text under its
    path. One expression takes a few levels apart, and deeper ones are columns built on it.
    """
    out = rows.withColumn("_nodes", _members(json))
    for done in range(0, max(depth - 1, 1), STEP):
        out = out.withColumn("_nodes", _down(F.col("_nodes"), min(STEP, depth - 1 - done)))
    return out.withColumn(name, _pairs(F.col("_nodes"), analysed)).drop("_nodes")


def properties_json(text: Column) -> Column:
    """JSON text as a variant; null when it does not parse."""
    return F.try_parse_json(text)

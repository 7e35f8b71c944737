"""Lookups: every function takes documents and returns the matching documents."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions.text import tokens
from docsift.plans.once import with_once
from docsift.plans.predicates import (Bool, Match, MatchAll, Nested, Prefix, Query, Term, Text, Wildcard,
                                      any_of, any_pair, condition, Fields, pair_equals,
                                      pair_key, terms_query)
from docsift.schema import DEFAULT_MAPPING, PROPS, FieldMapping


def _blank(value: str | None) -> bool:
    return value is None or not value.strip()


def nothing(docs: DataFrame) -> DataFrame:
    return docs.filter(F.lit(False))


def scope(docs: DataFrame, appid: str | None = None, type: str | None = None) -> DataFrame:
    """One tenant (its id is not trimmed) and, unless blank, one type."""
    if appid is not None:
        docs = docs.filter(F.col("appid") == appid)
    return docs if _blank(type) else docs.filter(F.col("type") == type)


def matching(docs: DataFrame, query: Query, type: str | None = None,
             mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    rows = scope(docs, type=type)
    if Fields(docs.schema, mapping).has_pairs():
        # a condition may look at the pairs many times; they are read, or flattened, once
        rows = with_once(rows, PROPS, F.col(PROPS))
    return rows.filter(condition(rows, query, mapping)).select(*docs.columns)


# what only the grammar of query strings gives a meaning
_SYNTAX = re.compile(r"""[:*?"()\[\]{}~^\\]|&&|\|\||(?:^|\s)[+\-!]\S|\b(?:AND|OR|NOT)\b""")


def find_by_id(docs: DataFrame, id: str | None) -> DataFrame:
    return nothing(docs) if _blank(id) else docs.filter(F.col("id") == id)


def _in_keys(docs: DataFrame, field: str, wanted: DataFrame) -> DataFrame:
    """Rows whose field occurs in the first column of `wanted`.

    The keys are made unique first, so one key repeated in many rows weighs no more than any other;
    Spark broadcasts them when they are small and shuffles both sides when they are not.
    """
    unique = (wanted.select(F.col(wanted.columns[0]).alias("_wanted"))
              .filter(F.col("_wanted").isNotNull()).distinct())
    return docs.join(unique, docs[field] == unique["_wanted"], "left_semi")


def _pairs_in_keys(docs: DataFrame, field: str, wanted: DataFrame) -> DataFrame:
    """Rows with a pair that has the key and one of a table of terms as its value: digits are looked up among
    the numbers, anything else among the words, all of which must occur.

    The pairs of the key are put into rows and meet the terms on the number or on the term's first word; only the
    keys of the matching documents come back to the documents.
    """
    typed = "kt" in docs.schema[PROPS].dataType.elementType.fieldNames()
    rows = docs.withColumn("_row", F.xxhash64("appid", "id") if "appid" in docs.columns else F.xxhash64("id"))
    pairs = (rows.select("id", "_row", F.explode(F.filter(PROPS, lambda p: pair_key(p, field, typed))).alias("p"))
             .select("id", "_row", F.col("p.vn").alias("vn"),
                     F.coalesce(F.col("p.vt") if typed else tokens(F.col("p.v")),
                                F.array().cast("array<string>")).alias("vt")))
    term = F.col(wanted.columns[0]).cast("string")
    terms = wanted.select(term.alias("term")).filter(F.col("term").isNotNull()).distinct()
    digits = F.col("term").rlike("^[0-9]+$")
    numbers = terms.filter(digits).select(F.col("term").cast("double").alias("vn")).distinct()
    words = terms.filter(~digits).select(tokens(F.col("term")).alias("words")).filter(F.size("words") > 0).select(
        "words", F.get("words", 0).alias("word"))
    by_number = pairs.join(numbers, "vn", "left_semi").select("id", "_row")
    by_word = (pairs.select("id", "_row", "vt", F.explode(F.array_distinct("vt")).alias("word")).join(words, "word")
               .filter(F.size(F.array_except("words", "vt")) == 0).select("id", "_row"))
    found = by_number.unionByName(by_word).distinct()
    return rows.join(found, ["id", "_row"], "left_semi").select(*docs.columns)


def find_by_ids(docs: DataFrame, ids: Sequence[str | None] | DataFrame | None) -> DataFrame:
    if isinstance(ids, DataFrame):
        return _in_keys(docs, "id", ids)
    wanted = [i for i in ids or () if i is not None]
    return docs.filter(F.col("id").isin(wanted)) if wanted else nothing(docs)


def find_term_in_list(docs: DataFrame, type: str | None, field: str | None,
                      terms: Sequence[Any] | DataFrame | None,
                      mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """The field holds one of the terms."""
    if _blank(field) or terms is None:
        return nothing(docs)
    scoped, fields = scope(docs, type=type), Fields(docs.schema, mapping)
    if isinstance(terms, DataFrame):
        return _pairs_in_keys(scoped, field, terms) if fields.is_pair(field) else _in_keys(scoped, field, terms)
    wanted = [t for t in terms if t is not None]
    if not wanted:
        return nothing(docs)
    if fields.is_pair(field):
        tests = [pair_equals(str(t)) for t in wanted]
        return with_once(scoped, PROPS, F.col(PROPS)).select(*docs.columns).filter(any_pair(fields, field, lambda p, typed: any_of(
            [F.coalesce(t(p, typed), F.lit(False)) for t in tests])))
    literals = [fields.literal(field, t) for t in wanted]
    return scoped.filter(fields.each(field, lambda u: u.isin(*literals)))


def find_prefix(docs: DataFrame, type: str | None, field: str | None, prefix: str | None,
                mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    if _blank(field) or _blank(prefix):
        return nothing(docs)
    return matching(docs, Prefix(field, prefix), type, mapping)


def find_wildcard(docs: DataFrame, type: str | None, field: str | None, pattern: str | None,
                  mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    if _blank(field) or _blank(pattern):
        return nothing(docs)
    return matching(docs, Wildcard(field, pattern), type, mapping)


def find_tagged(docs: DataFrame, type: str | None, tags: Sequence[str] | None) -> DataFrame:
    """Documents that carry every one of the tags."""
    if not tags:
        return nothing(docs)
    return matching(docs, Bool(must=tuple(Term("tags", t) for t in tags)), type)


def find_tags(docs: DataFrame, keyword: str | None) -> DataFrame:
    """Tag documents whose tag starts with the keyword, which may itself hold wildcards."""
    if _blank(keyword):
        return nothing(docs)
    return find_wildcard(docs, "tag", "tag", keyword + "*")


def find_terms(docs: DataFrame, type: str | None, terms: Mapping[str, Any] | None,
               match_all: bool = True, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    query = terms_query(terms, match_all)
    return nothing(docs) if query is None else matching(docs, query, type, mapping)


def find_query(docs: DataFrame, type: str | None, query: Query | str | None,
               mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """A predicate tree, or a plain text that may occur in any field; `*` means everything.

    A text that holds operators of a query string raises: it would be searched for as words otherwise.
    For ranked hits give the tree to `relevance.score_query`.
    """
    if query is None or (isinstance(query, str) and _blank(query)):
        return nothing(docs)
    if isinstance(query, str):
        if query.strip() != "*" and _SYNTAX.search(query):
            raise ValueError(f"{query!r} holds operators of a query string; build a tree with Q instead")
        query = MatchAll() if query.strip() == "*" else Text(query.strip())
    return matching(docs, query, type, mapping)


def find_nested_query(docs: DataFrame, type: str | None, field: str | None,
                      query: Query | str | None,
                      mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """One object of `nstd` matches: a text in `field`, or a tree over the object's own fields."""
    if query is None or (isinstance(query, str) and (_blank(query) or _blank(field))):
        return nothing(docs)
    if isinstance(query, str):
        query = MatchAll() if query.strip() == "*" else Match(field, query.strip())
    return matching(docs, Nested(query), type, mapping)

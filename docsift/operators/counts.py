"""Counts, each returned as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.operators.find import find_terms, scope
from docsift.schema import DEFAULT_MAPPING, FieldMapping


def get_count(docs: DataFrame, type: str | None = None,
              mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """All documents, or those of one type."""
    return scope(docs, type=type).agg(F.count(F.lit(1)).alias("count"))


def get_count_terms(docs: DataFrame, type: str | None, terms: Mapping[str, Any] | None,
                    mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """Documents that match all terms; no usable term counts nothing."""
    return find_terms(docs, type, terms, True, mapping).agg(F.count(F.lit(1)).alias("count"))


def total_hits(hits: DataFrame, cap: int | None = None) -> DataFrame:
    """Exact number of hits; with a cap every task stops reading once it has that many."""
    if cap is not None:
        hits = hits.select(F.lit(1).alias("hit")).limit(cap)
    return hits.agg(F.count(F.lit(1)).alias("total"))


def count_by_type(docs: DataFrame) -> DataFrame:
    return docs.groupBy("appid", "type").agg(F.count(F.lit(1)).alias("count"))

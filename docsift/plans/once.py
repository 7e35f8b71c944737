"""Columns that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever later steps do with it.

    Catalyst moves filters below a projection by repeating its expressions, which would analyse a text
    once per condition. It does not look into a generator, so the value is exploded from an array
    of one item: no shuffle, and conditions on other columns still reach the scan.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))

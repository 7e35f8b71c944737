"""Dates written in any of the accepted formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, in the order they are tried. Any all-digit text is therefore a number of milliseconds.
FORMATS = (
    "epoch_millis",
    "epoch_second",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "yyyyMMdd",
    "yyyy",
)


def _one(text: Column, fmt: str) -> Column:
    number = F.when(text.rlike(r"^-?[0-9]{1,18}$"), text).try_cast("bigint")
    if fmt == "epoch_millis":
        return F.timestamp_millis(number)
    if fmt == "epoch_second":
        return F.timestamp_seconds(F.when(F.abs(number) < 10**11, number))
    # the length test keeps a lenient pattern from taking a longer text
    return F.try_to_timestamp(F.when(F.length(text) == len(fmt), text), F.lit(fmt))


def parse_date(text: Column, formats: Sequence[str] = FORMATS) -> Column:
    """The first format that fits; null when none does.

    A number of milliseconds has up to 18 digits and one of seconds lies below 10^11; anything beyond is no
    date, and `check_batch` rejects the row.
    """
    trimmed = F.trim(text)
    return F.coalesce(*[_one(trimmed, fmt) for fmt in formats])

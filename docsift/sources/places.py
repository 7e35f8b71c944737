"""Documents laid out along a space-filling curve, so that a search around a point reads the row groups near it."""

from __future__ import annotations

import heapq
import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.geo import box_degrees

# The place on the curve, a column of the stored table.
PLACE = "_place"
# The globe is cut into 2^BITS columns and as many rows.
BITS = 16
# Stretches of the curve that a search names at most. Fewer are coarser, never incomplete.
STRETCHES = 32
FILE_ROWS = 1_000_000

# Shifts and masks that put a zero bit between each two of the 16 bits of a number.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def place_on_curve(lat: Column, lon: Column) -> Column:
    """The place of a point on the Z-curve over latitude and longitude; null without a point. Longitudes may be
    given in -180..180 or in 0..360."""
    cells = 1 << BITS

    def cell(share: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(cells - 1), F.floor(share * cells))).cast("bigint")

    x = _spread(cell(F.pmod(lon + 180.0, F.lit(360.0)) / 360.0))
    y = _spread(cell((lat + 90.0) / 180.0))
    return F.when(lat.isNotNull() & lon.isNotNull(), x.bitwiseOR(F.shiftleft(y, 1)))


def _interleave(x: int, y: int) -> int:
    return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(BITS))


def covering(lat: float, lon: float, radius_km: float, stretches: int = STRETCHES) -> list[tuple[int, int]]:
    """Stretches (first, last) of the curve that together hold every point of the circle.

    Squares that the circle's box only touches are cut in four, the largest first, while there are few.
    """
    cells = 1 << BITS
    half_lat, half_lon = box_degrees(lat, radius_km)

    def row(at: float) -> int:
        return min(cells - 1, max(0, math.floor((at + 90.0) / 180.0 * cells)))

    low, high = row(lat - half_lat) - 1, row(lat + half_lat) + 1  # one more for rounding
    if half_lon >= 180:
        spans = [(0, cells - 1)]
    else:
        middle = (lon + 180.0) % 360.0
        first = math.floor((middle - half_lon) / 360.0 * cells) - 1
        last = math.floor((middle + half_lon) / 360.0 * cells) + 1
        spans = [(first + turn, last + turn) for turn in (-cells, 0, cells)] if last - first < cells else [(0, cells - 1)]

    def meets(x: int, y: int, size: int) -> str | None:
        if y > high or y + size - 1 < low:
            return None
        near = [(a, b) for a, b in spans if x <= b and x + size - 1 >= a]
        if not near:
            return None
        inside = low <= y and y + size - 1 <= high and any(a <= x and x + size - 1 <= b for a, b in near)
        return "inside" if inside else "across"

    done, across = [], []

    def take(x: int, y: int, size: int) -> None:
        how = meets(x, y, size)
        if how == "inside" or how and size == 1:
            done.append((x, y, size))
        elif how:
            heapq.heappush(across, (-size, x, y))

    take(0, 0, cells)
    while across and len(done) + len(across) + 3 <= stretches:
        size, x, y = heapq.heappop(across)
        half = -size // 2
        for dx in (0, half):
            for dy in (0, half):
                take(x + dx, y + dy, half)
    starts = sorted((_interleave(x, y), size * size) for x, y, size in
                    [*done, *((x, y, -size) for size, x, y in across)])
    out: list[tuple[int, int]] = []
    for start, length in starts:
        if out and out[-1][1] + 1 == start:
            out[-1] = (out[-1][0], start + length - 1)
        else:
            out.append((start, start + length - 1))
    return out


def on_stretches(lat: float, lon: float, radius_km: float, stretches: int = STRETCHES) -> Column:
    """Plain ranges of the stored place, which reach the scan and choose row groups there."""
    return reduce(lambda a, b: a | b, [F.col(PLACE).between(first, last) for first, last in
                                       covering(lat, lon, radius_km, stretches)], F.lit(False))


def write_by_place(docs: DataFrame, path: str, file_rows: int = FILE_ROWS, group_bytes: int | None = None,
                   id_col: str = "id") -> DataFrame:
    """Store documents along the curve and read them back; `latlng` is a struct of `lat` and `lon`.

    Neighbouring files and row groups hold neighbouring points. A point with very many documents is spread over files
    by the hash of their ids. Documents without a point come first and are not met by a search. `group_bytes` sets
    the size of row groups.
    """
    here = F.col("latlng")
    placed = docs.withColumn(PLACE, place_on_curve(here["lat"], here["lon"]))
    files = max(1, math.ceil(placed.count() / file_rows))
    order = [F.col(PLACE), F.xxhash64(id_col)]
    writer = placed.repartitionByRange(files, *order).sortWithinPartitions(*order).write
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return read_by_place(docs.sparkSession, path)


def read_by_place(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

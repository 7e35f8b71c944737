"""Documents around a point, their parents, and a whole table of points at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.functions.geo import EARTH_KM, haversine_km, in_box
from docsift.operators.find import find_query, nothing, scope
from docsift.plans.predicates import Query
from docsift.plans.skew import salted_join
from docsift.schema import DEFAULT_MAPPING, FieldMapping
from docsift.sources.places import PLACE, on_stretches

ADDRESS = "address"


def nearby_addresses(docs: DataFrame, radius_km: float, lat: float, lon: float) -> DataFrame:
    """Address documents within the radius. The box is tested first, on the bare columns. A table stored by
    `places.write_by_place` is read only along the stretches of its curve that the circle touches."""
    here = F.col("latlng")
    stored = docs.filter(on_stretches(lat, lon, radius_km)) if PLACE in docs.columns else docs
    return (scope(stored, type=ADDRESS)
            .filter(in_box(here["lat"], here["lon"], lat, lon, radius_km))
            .filter(haversine_km(here["lat"], here["lon"], F.lit(lat), F.lit(lon)) <= radius_km))


def find_nearby(docs: DataFrame, type: str | None, query: Query | str | None, radius_km: float,
                lat: float, lon: float, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """Nearby addresses, or the documents of `type` that are the parent of one and match `query`.

    One plan with a semi-join on distinct parent ids; no list of ids passes through the driver.
    """
    if type is None or not type.strip():
        return nothing(docs)
    near = nearby_addresses(docs, radius_km, lat, lon)
    if type == ADDRESS:
        return near
    if query is None or (isinstance(query, str) and not query.strip()):
        query = "*"
    parents = (near.filter(F.col("parentid").isNotNull())
               .select(F.col("parentid").alias("_parent")).distinct())
    wanted = find_query(docs, type, query, mapping)
    return wanted.join(parents, wanted["id"] == parents["_parent"], "left_semi")


# ---------------------------------------------------------------- many points

def _band_height(radius_km: float) -> float:
    return max(math.degrees(radius_km / EARTH_KM), 1e-6)


def _cells_in_band(band: Column, height: float) -> Column:
    """Number of equal cells around the globe in one latitude band, each at least as wide, in
    kilometres, as the band is high."""
    far = F.greatest(F.abs(band * height - 90.0), F.abs((band + 1) * height - 90.0))
    return F.greatest(F.lit(1), F.floor(
        F.cos(F.radians(F.least(far, F.lit(90.0)))) * 360.0 / height)).cast("bigint")


def nearby_batch(points: DataFrame, places: DataFrame, radius_km: float,
                 point_id: str = "point_id", place_id: str = "id",
                 hot_rows: int = 1_000_000) -> DataFrame:
    """All pairs of a point and a place within the radius, with their distance.

    Both tables have `lat` and `lon`, the latter in -180..180 or 0..360. A place lies in one grid cell; a point asks for the few cells its
    circle touches, so the join is an equality on cells. Crowded cells are salted.
    """
    height = _band_height(radius_km)
    angle = radius_km / EARTH_KM

    def band_of(lat: Column) -> Column:
        return F.floor((lat + 90.0) / height)

    cells = _cells_in_band(F.col("band"), height)
    placed = (places.select(F.col(place_id).alias("place_id"), F.col("lat").alias("place_lat"),
                            F.col("lon").alias("place_lon"))
              .dropna().withColumn("band", band_of(F.col("place_lat")))
              .withColumn("cell", F.least(
                  F.floor(F.pmod(F.col("place_lon") + 180.0, F.lit(360.0)) / (F.lit(360.0) / cells)), cells - 1)))

    slack = 1e-9
    half = math.degrees(angle) + slack
    asked = points.select(F.col(point_id).alias("point_id"), F.col("lat").alias("point_lat"),
                          F.col("lon").alias("point_lon")).dropna()
    ratio = F.lit(math.sin(min(angle, math.pi / 2))) / F.cos(F.radians("point_lat"))
    over_pole = (F.abs("point_lat") + half >= 90) | (F.lit(angle) >= math.pi / 2)
    half_lon = F.when(over_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + slack)
    asked = (asked.withColumn("half_lon", half_lon)
             .withColumn("band", F.explode(F.sequence(band_of(F.col("point_lat") - half),
                                                      band_of(F.col("point_lat") + half))))
             .withColumn("cells", cells))
    width = F.lit(360.0) / F.col("cells")
    first = F.floor((F.col("point_lon") - F.col("half_lon") + 180.0) / width)
    last = F.floor((F.col("point_lon") + F.col("half_lon") + 180.0) / width)
    # a span of all cells names each of them once; a shorter one wraps around the date line
    span = F.when(last - first + 1 >= F.col("cells"), F.sequence(F.lit(0).cast("bigint"),
                                                                 F.col("cells") - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.col("cells"))))
    asked = asked.withColumn("cell", F.explode(F.array_distinct(span)))

    pairs = salted_join(placed, asked.drop("cells", "half_lon"), ["band", "cell"],
                        "place_id", "point_id", hot_rows)
    distance = haversine_km(F.col("point_lat"), F.col("point_lon"),
                            F.col("place_lat"), F.col("place_lon"))
    return (pairs.select("point_id", "place_id", distance.alias("km"))
            .filter(F.col("km") <= radius_km))

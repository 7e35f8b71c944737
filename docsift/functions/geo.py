"""Great-circle distance and the latitude/longitude box around a point."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in kilometres.
EARTH_KM = 6371.0087714


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_KM)


def box_degrees(lat: float, radius_km: float) -> tuple[float, float]:
    """Half height and half width, in degrees, of the box that holds the whole circle."""
    angle = radius_km / EARTH_KM
    half_lat = math.degrees(angle)
    if abs(lat) + half_lat >= 90 or angle >= math.pi / 2:
        return half_lat, 180.0
    return half_lat, math.degrees(math.asin(math.sin(angle) / math.cos(math.radians(lat))))


def in_box(lat: Column, lon: Column, at_lat: float, at_lon: float, radius_km: float) -> Column:
    """Plain range tests on the two columns, which reach the Parquet scan. Longitudes may be given in
    -180..180 or in 0..360."""
    at_lon = (at_lon + 180) % 360 - 180
    half_lat, half_lon = box_degrees(at_lat, radius_km)
    slack = 1e-9
    cond = lat.between(at_lat - half_lat - slack, at_lat + half_lat + slack)
    if half_lon >= 180:
        return cond
    west, east = at_lon - half_lon - slack, at_lon + half_lon + slack
    turns = [lon.between(west + turn, east + turn) for turn in (-360, 0, 360)
             if west + turn <= 360 and east + turn >= -180]
    return cond & reduce(lambda a, b: a | b, turns)


def parse_latlng(text: Column) -> Column:
    """`"40.67,-73.94"` -> struct<lat, lon>; null when it is not two numbers."""
    parts = F.split(text, ",")
    lat = F.trim(F.get(parts, F.lit(0))).try_cast("double")
    lon = F.trim(F.get(parts, F.lit(1))).try_cast("double")
    return F.when(lat.isNotNull() & lon.isNotNull(),
                  F.struct(lat.alias("lat"), lon.alias("lon")))

"""Geo search against all pairs, poles and date line included, and the salted join."""

import math
import random

import pytest
from conftest import ids
from pyspark.sql import functions as F

from docsift.functions.geo import EARTH_KM, parse_latlng
from docsift.operators.nearby import nearby_addresses, nearby_batch
from docsift.plans.skew import hot_keys, key_counts, salted_join
from docsift.session import scratch_path
from docsift.sources.places import BITS, covering, write_by_place


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 2 * EARTH_KM * math.asin(min(1.0, math.sqrt(h)))


def places(seed, n):
    rng = random.Random(seed)
    out = [(90.0, 0.0), (-90.0, 10.0), (89.9, -179.9), (0.0, 180.0), (0.0, -180.0), (0.1, 179.9)]
    for _ in range(n):
        out.append((math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)))
    return out


@pytest.mark.parametrize("radius", [5, 300, 2000, 9000, 15000])
def test_batch(spark, radius):
    spots, asked = places(1, 150), places(2, 60)
    p = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id int, lat double, lon double")
    q = spark.createDataFrame([(i, *s) for i, s in enumerate(asked)], "point_id int, lat double, lon double")
    got = [(r["point_id"], r["place_id"]) for r in nearby_batch(q, p, radius, hot_rows=5).collect()]
    want = {(i, j) for i, a in enumerate(asked) for j, b in enumerate(spots) if km(a, b) <= radius}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("at", [(0.0, 179.95), (89.5, 20.0), (-45.0, -179.0), (40.6, -73.9)])
def test_one_point(spark, at):
    spots = places(3, 300)
    docs = spark.createDataFrame([(str(i), "address", s) for i, s in enumerate(spots)],
                                 "id string, type string, latlng struct<lat: double, lon: double>")
    got = ids(nearby_addresses(docs, 1500, *at))
    assert got == sorted(str(i) for i, s in enumerate(spots) if km(at, s) <= 1500)


@pytest.mark.parametrize("at", [(0.0, 179.95), (89.5, 20.0), (-45.0, -179.0), (40.6, -73.9), (-90.0, 0.0)])
@pytest.mark.parametrize("radius", [20, 1500, 12000])
def test_stored_by_place(spark, at, radius):
    spots = [*places(3, 400), None, (12.0, 300.0)]
    docs = spark.createDataFrame([(str(i), "address", s) for i, s in enumerate(spots)],
                                 "id string, type string, latlng struct<lat: double, lon: double>")
    stored = write_by_place(docs, scratch_path(spark, "places"), file_rows=50)
    assert stored.count() == len(spots)
    assert ids(nearby_addresses(stored, radius, *at)) == sorted(
        str(i) for i, s in enumerate(spots) if s is not None and km(at, s) <= radius)


def test_covering_is_small_and_apart():
    for radius in (1, 100, 3000):
        found = covering(48.1, 11.5, radius)
        assert len(found) <= 32 and all(a <= b for a, b in found)
        assert all(b + 1 < c for (_, b), (c, _) in zip(found, found[1:]))
    assert covering(0.0, 0.0, 21000) == [(0, (1 << 2 * BITS) - 1)]


def test_search_reads_few_row_groups(spark):
    """A hot point holds a third of all documents and is spread over files; a search elsewhere does not read them."""
    docs = spark.range(60_000).selectExpr(
        "cast(id as string) id", "'address' type", "named_struct('lat', if(id % 3 = 0, 10.0D, id * 37 % 1700 / 10 - 85), "
        "'lon', if(id % 3 = 0, 20.0D, id * 91 % 3600 / 10 - 180)) latlng")
    stored = write_by_place(docs, scratch_path(spark, "places"), file_rows=1000)
    found = nearby_addresses(stored, 300, 50.0, -100.0)
    rows = len(found.collect())
    assert rows == nearby_addresses(docs, 300, 50.0, -100.0).count() > 0
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [Or" in plan.verboseStringWithOperatorId() or "_place" in plan.toString()
    read = plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert rows <= read < 60_000 / 10


def test_latlng(spark):
    df = spark.createDataFrame([("40.67,-73.94",), ("x,1",), ("5",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_latlng(F.col("s"))).collect()]
    assert tuple(got[0]) == (40.67, -73.94) and got[1:] == [None] * 3


def test_salted_join_meets_each_pair_once(spark):
    left = spark.range(600).selectExpr("id AS l", "IF(id % 3 = 0, 0, id % 50) AS k")
    right = spark.range(300).selectExpr("id AS r", "IF(id % 3 = 0, 0, id % 70) AS k")
    want = sorted(map(tuple, left.join(right, "k").select("l", "r").collect()))
    got = salted_join(left, right, ["k"], "l", "r", hot_rows=20)
    assert sorted(map(tuple, got.select("l", "r").collect())) == want
    unique = right.groupBy("k").agg(F.max("r").alias("r"))
    one = salted_join(left, unique, ["k"], "l", "k", hot_rows=20, right_unique=True)
    assert one.count() == left.join(unique, "k").count()
    parts = {r["k"]: (r["_lp"], r["_rp"]) for r in hot_keys(
        key_counts(left, right, ["k"]), ["k"], 20).collect()}
    assert set(parts) == {0} and parts[0] == (11, 6)

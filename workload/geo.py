"""Places around one point or many."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators.nearby import find_nearby, nearby_addresses, nearby_batch
from docsift.plans.predicates import Q
from docsift.session import scratch_path
from docsift.sources.places import write_by_place
from workload.common import query, table

LAT, LON, RADIUS = 50.0, 179.0, 2500
BATCH_RADIUS = 300


def _lat(key: str) -> str:
    return f"CAST({key} * 37 % 1700 AS DOUBLE) / 10 - 85"


def _lon(key: str) -> str:
    return f"CAST({key} * 91 % 3600 AS DOUBLE) / 10 - 180"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371.0087714 * asin(sqrt(least(1.0, power(sin(radians({lat2} - ({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * power(sin(radians({lon2} - ({lon1})) / 2), 2))))")


def _documents(spark, sf):
    """Suppliers as addresses and nations as their parents, in one table of documents."""
    address = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit("address").alias("type"),
        F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("parentid"),
        F.struct(F.expr(_lat("s_suppkey")).alias("lat"), F.expr(_lon("s_suppkey")).alias("lon"))
        .alias("latlng"))
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.lit("nation").alias("type"),
        F.col("n_name").alias("name"))
    return address.unionByName(nation, allowMissingColumns=True)


SUPPLIERS = f"""(SELECT s_suppkey AS id, s_name AS name, s_nationkey AS parentid,
 {_lat('s_suppkey')} AS lat, {_lon('s_suppkey')} AS lon FROM supplier)"""
NEAR = f"{_km(str(LAT), str(LON), 'lat', 'lon')} <= {RADIUS}"


@query("nearby_addresses", f"SELECT id, name, parentid FROM {SUPPLIERS} WHERE {NEAR}")
def nearby(spark, sf):
    return nearby_addresses(_documents(spark, sf), RADIUS, LAT, LON).select("id", "name", "parentid")


@query("nearby_parents", f"""SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
 WHERE n_nationkey IN (SELECT parentid FROM {SUPPLIERS} WHERE {NEAR})""")
def nearby_parents(spark, sf):
    return find_nearby(_documents(spark, sf), "nation", "*", RADIUS, LAT, LON).select("id", "name")


@query("nearby_parents_query", f"""SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
 WHERE n_nationkey IN (SELECT parentid FROM {SUPPLIERS} WHERE {NEAR}) AND n_name >= 'NATION_1'""")
def nearby_parents_query(spark, sf):
    tree = Q.range("name", "NATION_1", "*")
    return find_nearby(_documents(spark, sf), "nation", tree, RADIUS, LAT, LON).select("id", "name")


@query("nearby_batch_turned", f"""SELECT point_id, place_id, round(km, 6) AS km FROM (
 SELECT c_custkey AS point_id, id AS place_id,
  {_km(_lat('c_custkey * 53'), _lon('c_custkey * 17'), 'lat', 'lon')} AS km
 FROM customer, {SUPPLIERS}) WHERE km <= {BATCH_RADIUS}""")
def nearby_pairs_turned(spark, sf):
    """The same pairs, with the places' longitudes written in 0..360."""
    places = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.expr(_lat("s_suppkey")).alias("lat"),
        F.pmod(F.expr(_lon("s_suppkey")), F.lit(360.0)).alias("lon"))
    points = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("point_id"), F.expr(_lat("c_custkey * 53")).alias("lat"),
        F.expr(_lon("c_custkey * 17")).alias("lon"))
    return nearby_batch(points, places, BATCH_RADIUS).select("point_id", "place_id", F.round("km", 6).alias("km"))


@query("nearby_batch", f"""SELECT point_id, place_id, round(km, 6) AS km FROM (
 SELECT c_custkey AS point_id, id AS place_id,
  {_km(_lat('c_custkey * 53'), _lon('c_custkey * 17'), 'lat', 'lon')} AS km
 FROM customer, {SUPPLIERS}) WHERE km <= {BATCH_RADIUS}""")
def nearby_pairs(spark, sf):
    places = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.expr(_lat("s_suppkey")).alias("lat"),
        F.expr(_lon("s_suppkey")).alias("lon"))
    points = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("point_id"), F.expr(_lat("c_custkey * 53")).alias("lat"),
        F.expr(_lon("c_custkey * 17")).alias("lon"))
    pairs = nearby_batch(points, places, BATCH_RADIUS)
    return pairs.select("point_id", "place_id", F.round("km", 6).alias("km"))


CUSTOMERS = f"""(SELECT c_custkey AS id, c_nationkey AS parentid, {_lat('c_custkey * 53')} AS lat,
 {_lon('c_custkey * 17')} AS lon FROM customer)"""


def _stored_customers(spark, sf):
    """Customers as addresses, nations as their parents, laid out along the curve."""
    address = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("bigint").alias("id"), F.lit("address").alias("type"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("parentid"),
        F.struct(F.expr(_lat("c_custkey * 53")).alias("lat"), F.expr(_lon("c_custkey * 17")).alias("lon")).alias("latlng"))
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.lit("nation").alias("type"), F.col("n_name").alias("name"))
    return write_by_place(address.unionByName(nation, allowMissingColumns=True), scratch_path(spark, "places"),
                          file_rows=2000)


@query("nearby_stored", f"SELECT CAST(id AS BIGINT) AS id FROM {CUSTOMERS} WHERE {NEAR}")
def nearby_stored(spark, sf):
    return nearby_addresses(_stored_customers(spark, sf), RADIUS, LAT, LON).select("id")


@query("nearby_parents_stored", f"""SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
 WHERE n_nationkey IN (SELECT parentid FROM {CUSTOMERS} WHERE {NEAR})""")
def nearby_parents_stored(spark, sf):
    return find_nearby(_stored_customers(spark, sf), "nation", "*", RADIUS, LAT, LON).select("id", "name")

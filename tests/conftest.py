import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docsift.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "docsift-tests", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__driver__memory="4g",
                            spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NOTE_1 = "The ferry leaves the north pier at seven and returns by noon."
NOTE_2 = "At noon the ferry returns; it leaves the north pier again by seven."
NOW = "1700000000000"


@pytest.fixture(scope="session")
def people(spark):
    """Three users, a tag, two addresses, two notes and a record with nested objects."""
    from pyspark.sql import functions as F

    from docsift.operators.normalize import normalize
    old = "946684800000"  # the first second of 2000
    rows = [
        # id, type, name, email, timestamp, tags, tag, count, latlng, parentid, properties
        ("u-ada", "user", "Ada Quill", "ada@lake.example", old, ["chess", "tea", "hiking"],
         None, None, None, None, None),
        ("u-bo", "user", "Bo Ferrant", "bo@lake.example", NOW, ["tea", "piano"], None, None, None, None, None),
        ("u-cyra", "user", "Cyra Moss", "cyra@hill.example", NOW, ["piano", "rowing", "hiking", "tea"],
         None, None, None, None, None),
        ("tag:tea", "tag", "tea", None, NOW, None, "tea", 12, None, None, None),
        ("home", "address", None, None, NOW, None, None, None, "47.37,8.54", "u-ada", None),
        ("hall", "address", None, None, NOW, None, None, None, "47.50,8.73", "tag:tea", None),
        ("n1", "note", None, None, NOW, None, None, None, None, None, {"text": NOTE_1}),
        ("n2", "note", None, None, NOW, None, None, None, None, None, {"text": NOTE_2}),
        ("shelf", "record", None, None, NOW, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(
        [(*r[:-1], json.dumps(r[-1]) if r[-1] else None) for r in rows],
        "id string, type string, name string, email string, timestamp string, tags array<string>, tag string, "
        "count bigint, latlng string, parentid string, properties string")
    objects = ("array(struct('o1' AS id, struct('green teapot' AS text) AS properties),"
               "struct('o2' AS id, struct('blue kettle' AS text) AS properties))")
    df = (df.withColumn("appid", F.lit("lake")).withColumn("identifier", F.col("email"))
          .withColumn("nstd", F.expr(f"CASE WHEN id = 'shelf' THEN {objects} END")))
    return normalize(df).cache()


@pytest.fixture(scope="session")
def boats(spark):
    """Three documents whose properties are nested several levels deep."""
    from docsift.operators.normalize import normalize
    logs = ["Calm water; the crew painted the deck and mended two sails.",
            "The crew mended the deck. Two sails painted, water calm, wind low.",
            "Engine trouble near the lighthouse - towed home."]
    crews = [("Nadia", 41, ["ka4", "ka5"], ["lee", "ito"], 1988), ("Omar", 47, ["mb1", "mb7"], ["ruiz", "sato"], 1996),
             ("Petra", 52, ["tz3", "tz6"], ["voss", "ivy"], 2011)]
    rows = []
    for n, ((skipper, age, sails, crew, built), log) in enumerate(zip(crews, logs), 1):
        props = {"skipper": {"name": skipper, "age": age}, "rig": {"sails": [{"code": c} for c in sails], "crew": crew},
                 "built": built, "log": log}
        rows.append((f"b{n}", "lake", "boat", f"Heron {n + 6}", str(86_400_000 * 10 ** n),
                     ["racing", "wood"] if n == 3 else None, json.dumps(props)))
    df = spark.createDataFrame(rows, "id string, appid string, type string, name string, timestamp string, "
                                     "tags array<string>, properties string")
    return normalize(df).cache()


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def in_order(df):
    return [r["id"] for r in df.select("id").collect()]

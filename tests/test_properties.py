"""Flattening, restoring, dates and normalisation."""

import json
from datetime import datetime

import pytest
from conftest import ids
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsift.functions.dates import parse_date
from docsift.functions.keys import is_digits, nested_key, split_operator
from docsift.functions.props import properties_json, with_flattened
from docsift.operators import find
from docsift.operators.normalize import normalize, property_rows, restore
from docsift.plans.predicates import Q


def flat(spark, *texts, depth=8):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    rows = property_rows(df, "p", ["i"], depth).collect()
    return [{r["k"]: r["v"] if r["vn"] is None else r["vn"] for r in rows if r["i"] == i}
            for i in range(len(texts))]


def test_rules(spark):
    got = flat(
        spark,
        '{"a":{"b":1},"c":[1,"x",[true]],"d":null,"e":[null,2],"f":{},"g":[],"h":"34","i":9.5,"j":false}',
        "{}", None, "[1]", "{bad", '"text"', '{"":{"z":1}}', '{"a-b":1,"a":{"b":2}}',
        '{"big":12345678901234567890123,"s":1e3,"neg":-5}', '{"l":[[],[null],{}]}')
    assert got[0] == {"a-b": 1.0, "c-0": 1.0, "c-1": "x", "c-2-0": "true", "d": "null", "e-1": 2.0,
                      "h": "34", "i": 9.5, "j": "false"}
    assert got[1:6] == [{}] * 5
    assert got[6] == {"z": 1.0}
    assert set(got[7]) == {"a-b"}
    assert got[8] == {"big": 12345678901234567890123.0, "s": 1000.0, "neg": -5.0}
    assert got[9] == {}


def test_depth(spark):
    text = '{"a":{"b":{"c":{"d":1}},"e":{}}}'
    assert flat(spark, text) == [{"a-b-c-d": 1.0}]
    assert flat(spark, text, depth=2) == [{"a-b": '{"c":{"d":1}}'}]


SCALAR = st.none() | st.booleans() | st.integers(-10**9, 10**9) | st.text("ab \"'", max_size=4)
TREE = st.recursive(SCALAR, lambda c: st.lists(c, max_size=3)
                    | st.dictionaries(st.text("xyz", min_size=1, max_size=2), c, max_size=3),
                    max_leaves=8)


def expected(value, path="", in_object=True):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from expected(v, f"{path}-{k}" if path else k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from expected(v, f"{path}-{i}", False)
    elif value is None:
        if in_object:
            yield path, "null"
    elif isinstance(value, bool):
        yield path, str(value).lower()
    else:
        yield path, float(value) if isinstance(value, int) else value


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs=st.lists(st.dictionaries(st.text("abc", min_size=1, max_size=2), TREE, max_size=3),
                     min_size=20, max_size=30))
def test_any_object(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, p string")
    rows = property_rows(df, "p", ["i"]).collect()
    for i, doc in enumerate(docs):
        got = sorted((r["k"], str(r["v"] if r["vn"] is None else r["vn"])) for r in rows if r["i"] == i)
        assert got == sorted((k, str(v)) for k, v in expected(doc))


def test_restore(spark):
    text = '{"a":{"b":[1,null]},"c":null}'
    rows = spark.createDataFrame([("1", "app", text, "x"), ("2", "app", None, "x"), ("3", "app", "{", "x")],
                                 "id string, appid string, properties string, settings string")
    docs = normalize(rows)
    assert "settings" not in docs.columns and "_docid" in docs.columns
    back = restore(docs)
    assert set(back.columns) == {"id", "appid", "properties"}
    got = {r["id"]: r["p"] for r in back.select("id", F.to_json("properties").alias("p")).collect()}
    assert json.loads(got["1"]) == json.loads(text) and got["2"] is None and got["3"] is None
    typed = restore(docs, "struct<c: string, a: struct<b: array<int>>>").filter("id = '1'").first()
    assert typed["properties"]["a"]["b"] == [1, None]


def test_struct_properties(spark):
    rows = spark.sql("SELECT '1' id, 'a' appid, named_struct('x', 1, 'y', named_struct('z', 'w')) properties")
    pairs = normalize(rows).select(F.inline("properties")).collect()
    assert {(r["k"], r["v"], r["vn"]) for r in pairs} == {("x", None, 1.0), ("y-z", "w", None)}


@pytest.mark.parametrize("text,want", [
    ("1000000000", datetime(1970, 1, 12, 13, 46, 40)),
    ("20240115", datetime(1970, 1, 1, 5, 37, 20, 115000)),  # all digits are milliseconds
    ("2024-01-15 10:20:30", datetime(2024, 1, 15, 10, 20, 30)),
    ("2024-01-15", datetime(2024, 1, 15)),
    ("2024/01/15", datetime(2024, 1, 15)),
    (" 2024-01-15 ", datetime(2024, 1, 15)),
    ("soon", None), ("", None), ("2024-13-15", None), ("99999999999999999999", None)])
def test_dates(spark, text, want):
    got = spark.range(1).select(F.date_format(parse_date(F.lit(text)), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert got == (None if want is None else want.strftime("%Y-%m-%d %H:%M:%S.%f")[:23])


def test_date_order_is_an_option(spark):
    def one(text, *formats):
        return str(spark.range(1).select(F.date_format(
            parse_date(F.lit(text), formats), "yyyy-MM-dd")).first()[0])
    assert one("20240115", "yyyyMMdd", "epoch_millis") == "2024-01-15"
    assert one("2024", "yyyy", "epoch_millis") == "2024-01-01"
    assert one("1705276800", "epoch_second") == "2024-01-15"


def test_keys():
    assert nested_key("properties.a[2].b") == "a-2-b"
    assert nested_key("name") == "name"
    assert split_operator("timestamp <=") == ("timestamp", "<=")
    assert split_operator("a.b>") == ("a.b", ">")
    assert split_operator(" name ") == ("name", None)
    assert is_digits("34") and not is_digits("-5") and not is_digits("9.5") and not is_digits("")


def test_slots(spark):
    """The search term decides which slot is looked at."""
    rows = spark.createDataFrame([("n", "a", '{"x":34}'), ("s", "a", '{"x":"34"}'), ("m", "a", '{"x":-5}'),
                                  ("t", "a", '{"x":"-5"}')],
                                 "id string, appid string, properties string")
    docs = normalize(rows)
    assert ids(find.find_terms(docs, None, {"properties.x": "34"})) == ["n"]
    assert ids(find.find_terms(docs, None, {"properties.x": "-5"})) == ["t"]
    assert ids(find.find_terms(docs, None, {"properties.x >": 3})) == ["n"]


def test_same_pair(spark):
    rows = spark.createDataFrame([("1", "a", '{"p":{"name":"ann"},"q":{"name":"bob"}}')],
                                 "id string, appid string, properties string")
    docs = normalize(rows)
    assert ids(find.find_terms(docs, None, {"properties.p.name": "ann"})) == ["1"]
    assert ids(find.find_terms(docs, None, {"properties.p.name": "bob"})) == []
    assert ids(find.find_terms(docs, None, {"properties.name": "bob"})) == ["1"]


def test_unflattened(spark):
    rows = spark.createDataFrame([("1", '{"a":{"b":7},"t":"Red fox"}'), ("2", '{"a":{"b":"x"}}')],
                                 "id string, p string")
    docs = rows.select("id", properties_json(F.col("p")).alias("properties"))
    assert ids(find.find_query(docs, None, Q.term("properties.a.b", 7))) == ["1"]
    assert ids(find.find_query(docs, None, Q.range("properties.a.b", 5, "*"))) == ["1"]
    assert ids(find.find_query(docs, None, Q.term("properties.t", "fox"))) == ["1"]
    assert ids(find.find_query(docs, None, Q.prefix("properties.a.b", "x"))) == ["2"]
    assert ids(find.find_query(docs, None, Q.exists("properties.t"))) == ["1"]
    struct = rows.select("id", F.from_json("p", "struct<a: struct<b: string>, t: string>").alias("properties"))
    assert ids(find.find_query(struct, None, Q.term("properties.t", "red"))) == ["1"]


def test_flatten_in_one_stage(spark):
    """No shuffle and no repeated flattening: the generator stays between scan and filter."""
    rows = spark.createDataFrame([("1", "a", "{}")], "id string, appid string, properties string")
    hits = find.find_terms(normalize(rows), None, {"properties.a": "x", "properties.b": "y"})
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("parseJson") == 1


def test_unanalysed_pairs(spark):
    df = spark.createDataFrame([('{"a":"X y"}',)], "p string")
    short = with_flattened(df, "x", properties_json(F.col("p")), 1, analysed=False)
    assert short.schema["x"].dataType.elementType.fieldNames() == ["k", "v", "vn"]
    full = with_flattened(df, "x", properties_json(F.col("p")), 1).first()["x"][0]
    assert full["kt"] == ["a"] and full["vt"] == ["x", "y"]

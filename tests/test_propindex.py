"""The stored index of properties against the same conditions on normalised documents."""

import json
import random

import pytest
from conftest import ids

from docsift.operators.normalize import normalize
from docsift.operators.propindex import open_index, write_index
from docsift.plans.paging import Page, take_page
from docsift.plans.predicates import Q, condition
from docsift.session import scratch_path

BIG = 9007199254740992


def documents():
    rng = random.Random(4)
    rows = []
    for i in range(120):
        props = {"owner": {"age": rng.randrange(60), "name": rng.choice(["Red Fox", "red hen", "Blue fox", "o'neil"])},
                 "marks": [rng.choice(["alpha", "alpine", "beta", 7, 7.5, None]) for _ in range(rng.randrange(4))],
                 "n": BIG + i % 5, "code": rng.choice(["x-1", "y", "", "12"])}
        for gone in rng.sample(sorted(props), rng.randrange(3)):
            del props[gone]
        rows.append((str(i), "ab"[i % 2], rng.choice(["cat", "dog"]), json.dumps(props)))
    return rows + [("none", "a", "cat", None), ("bad", "a", "dog", "{"), ("empty", "b", "cat", "{}"), ("0", "b", "dog", '{"n": 3}')]


@pytest.fixture(scope="module")
def stored(spark):
    docs = normalize(spark.createDataFrame(documents(), "id string, appid string, type string, properties string"))
    root = scratch_path(spark, "properties")
    write_index(docs, root, file_rows=100)
    return docs, open_index(spark, root)


TREES = [
    Q.range("properties.owner.age", 20, 40), Q.range("properties.owner.age", 20, "*", include_low=False),
    Q.range("properties.n", BIG + 1, BIG + 2), Q.range("properties.n", BIG + 1, BIG + 3, include_low=False, include_high=False),
    Q.range("properties.marks", "alpha", "alpz"), Q.range("properties.marks", "*", "*"), Q.range("properties.marks", 7, 7),
    Q.range("properties.marks", "6.5", 8), Q.term("properties.n", BIG + 1), Q.term("properties.owner.name", "FOX red"),
    Q.term("properties.owner.name", "*"), Q.term("properties.marks[0]", "beta"), Q.term("properties:code", "12"),
    Q.match("properties.owner.name", "o'neil"), Q.exists("properties.marks"), Q.exists("properties.nothing"),
    Q.prefix("properties.marks", "alp"), Q.wildcard("properties.marks", "*a"), Q.fuzzy("properties.marks", "alpah"),
    Q.prefix("properties.n", "9"), Q.text("fox"), Q.term("type", "cat"), Q.term("properties.code", "!!"),
    Q.term("properties.owner.name", "red") & Q.range("properties.owner.age", "*", 30) & Q.term("type", "cat"),
    Q.term("properties.marks", "beta") | Q.term("properties.owner.age", 7) | Q.term("type", "dog"),
    ~Q.term("properties.owner.name", "fox"), Q.bool(must=[Q.term("type", "cat")], should=[Q.term("properties.n", 3)]),
    Q.bool(filter=[~Q.exists("properties.n")], must_not=[Q.term("properties.code", "y"), Q.term("appid", "a")]),
]


@pytest.mark.parametrize("tree", TREES, ids=str)
def test_same_as_on_documents(stored, tree):
    docs, index = stored
    want = docs.filter(condition(docs, tree)).select("id", "appid").collect()
    got = index.find(tree)
    assert got.columns == index.docs.columns
    assert sorted(got.select("id", "appid").collect()) == sorted(want)


@pytest.mark.parametrize("sort", ["properties.owner.age:desc, id:asc", "properties.marks:asc", "type:asc, properties.n:desc",
                                  "id:desc", "properties.nothing:asc"])
def test_same_order(stored, sort):
    docs, index = stored
    page = Page(limit=50, number=2, sort=sort)
    docs, found = docs.filter("appid = 'a'"), index.docs.filter("appid = 'a'")
    assert [r["id"] for r in index.page(found, page).collect()] == [r["id"] for r in take_page(docs, page).collect()]


def test_nothing_parses_json_and_filters_reach_the_scan(spark):
    rows = spark.range(20_000).selectExpr(
        "cast(id as string) id", "'a' appid", "to_json(named_struct('n', id, 'm', id % 7, 'w', concat('w', id % 11))) properties")
    index = write_index(normalize(rows), scratch_path(spark, "properties"), file_rows=2000)
    found = index.find(Q.range("properties.n", 100, 120) & Q.term("properties.w", "w3"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "variant" not in plan
    assert "GreaterThanOrEqual(vn,100.0)" in plan.replace(" ", "") or "vn" in plan.split("PushedFilters")[1]
    assert ids(found) == sorted(str(i) for i in range(100, 121) if i % 11 == 3)
    # rows of the pairs that a range reads: its files and row groups, not the table
    one = index.pairs.filter(index._leaf(Q.range("properties.n", 100, 120))[0])
    assert one.count() == 21
    read = one.select("id")
    read.collect()
    scanned = read._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    assert scanned <= 60_000 / 10


def test_empty(spark):
    docs = normalize(spark.createDataFrame([], "id string, appid string, properties string"))
    index = write_index(docs, scratch_path(spark, "properties"))
    assert index.find(Q.term("properties.a", "b")).collect() == []
    assert index.find(~Q.term("properties.a", "b")).collect() == []


def test_pairs_hold_words_once(spark, monkeypatch):
    """A row of the pairs has no words of its key, and those of its value only if there are several."""
    values = {"1": "tea", "2": "tea tea", "3": "green tea", "4": "green"}
    rows = spark.createDataFrame([(i, "a", json.dumps({"drink": {"name": v}})) for i, v in values.items()],
                                 "id string, appid string, properties string")
    index = write_index(normalize(rows), scratch_path(spark, "properties"))
    assert "kt" not in index.pairs.columns
    assert {r["id"] for r in index.pairs.filter("vt IS NOT NULL").collect()} == {"3"}
    for named in (500, 0):  # keys by name, and by their words
        monkeypatch.setattr("docsift.operators.propindex.NAMED_KEYS", named)
        for value, want in (("tea", "123"), ("tea tea", "123"), ("tea green", "3"), ("Green", "34")):
            assert ids(index.find(Q.term("properties.drink.name", value))) == list(want), (named, value)

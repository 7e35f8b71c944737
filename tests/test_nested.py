"""Predicates, similarity and sorting on dynamic properties."""

import pytest
from conftest import ids, in_order
from pyspark.sql import functions as F

from docsift.operators import find
from docsift.operators.normalize import normalize
from docsift.operators.relevance import find_similar
from docsift.plans.paging import Page, take_page
from docsift.plans.predicates import Q

NAME, AGE, LOG = "properties.skipper.name", "properties.skipper.age", "properties.log"
ALL = ["b1", "b2", "b3"]


def hits(docs, query):
    return ids(find.find_query(docs, "boat", query))


@pytest.mark.parametrize("field,terms,want", [
    (NAME, ["nadia", "PETRA"], ["b1", "b3"]), (NAME, ["Nad"], []), (AGE, [41, "52"], ["b1", "b3"]), (NAME, [], []),
    ("properties.rig.crew", ["ivy", "sato"], ["b2", "b3"])])
def test_in_list(boats, spark, field, terms, want):
    assert ids(find.find_term_in_list(boats, "boat", field, terms)) == want
    if terms:
        table = spark.createDataFrame([(str(t),) for t in [*terms, None]], "t string")
        assert ids(find.find_term_in_list(boats, "boat", field, table)) == want


@pytest.mark.parametrize("query,want", [
    (Q.prefix(NAME, "pet"), ["b3"]), (Q.prefix(NAME, "Pet"), []), (Q.wildcard(NAME, "*a"), ["b1", "b3"]),
    (Q.wildcard(LOG, "paint*"), ["b1", "b2"]), (Q.fuzzy(LOG, "lihgthouse"), ["b3"]), (Q.fuzzy("name", "Heron7"), ALL)])
def test_patterns_look_at_words(boats, query, want):
    assert hits(boats, query) == want


@pytest.mark.parametrize("query,want", [
    (Q.text("Heron 8") & Q.term(AGE, 47), ["b2"]),
    (Q.range("timestamp", 864000000, "*", include_low=False) & Q.range(AGE, "*", 47), ["b2"]),
    (~Q.range(AGE, "*", 41), ["b2", "b3"]), (Q.term(NAME, "Petra"), ["b3"]), (Q.exists(AGE), ALL), (Q.term(AGE, "*"), ALL),
    (Q.range(AGE), ALL), (Q.term("properties.rig.sails[1].code", "mb7"), ["b2"]),
    (Q.term("properties.rig.sails[0].code", "mb7"), []), (Q.term("properties.rig.crew", "ivy"), ["b3"]),
    (Q.text("canoe") & Q.term(AGE, 47), []), (Q.text("racing") & Q.term(AGE, 52), ["b3"]),
    (Q.text("racing") | Q.text("Omar"), ["b2", "b3"]), (Q.text("canoe") | Q.term(AGE, 47), ["b2"]),
    (Q.text("lighthouse") & Q.wildcard(LOG, "sail*"), []), (Q.text("wood") | Q.text("deck"), ALL)])
def test_trees(boats, query, want):
    assert hits(boats, query) == want


@pytest.mark.parametrize("spelling", ["properties.built", "properties:built", "doc.properties.built"])
def test_ways_to_name_a_property(boats, spelling):
    assert hits(boats, Q.range(spelling, 1990, 2000)) == ["b2"]


@pytest.mark.parametrize("low_in,high_in,want", [(True, True, ALL), (True, False, ["b1", "b2"]), (False, False, ["b2"])])
def test_text_range(boats, low_in, high_in, want):
    assert hits(boats, Q.range(NAME, "nadia", "petra", low_in, high_in)) == want


@pytest.mark.parametrize("query,want", [
    ("properties.rig.crew", []), ("lighthouse", ["b3"]), ("towed", ["b3"]), (Q.prefix(None, "pain"), ["b1", "b2"]),
    (Q.wildcard(None, "eng?ne"), ["b3"]), (Q.prefix(None, "Heron"), []), (Q.prefix(None, "Heron 7"), ["b1"]),
    (Q.fuzzy(None, "mendde"), ["b1", "b2"])])
def test_without_a_field(boats, query, want):
    assert hits(boats, query) == want


def test_terms_with_ranges(boats):
    terms = {"timestamp >": 864000000, AGE + " >=": 41}
    assert ids(find.find_terms(boats, "boat", terms, True)) == ["b2", "b3"]
    assert ids(find.find_terms(boats, "boat", terms, False)) == ALL
    assert ids(find.find_terms(boats, "boat", {"properties.rig.sails[1].code": "tz6"})) == ["b3"]


def test_optional_should(boats):
    age, nadia = Q.range(AGE, 47, "*"), Q.term(NAME, "nadia")
    assert hits(boats, Q.bool(must=[age], should=[nadia])) == ["b2", "b3"]
    assert hits(boats, Q.bool(filter=[age], should=[nadia])) == ["b2", "b3"]
    assert hits(boats, Q.bool(should=[nadia], must_not=[age])) == ["b1"]
    assert hits(boats, Q.bool()) == hits(boats, Q.match_all()) == ALL
    assert hits(boats, Q.boost(Q.term(NAME, "omar"), 3)) == ["b2"]


def test_similar(boats):
    log = {r["id"]: r["v"] for r in boats.select("id", F.explode("properties").alias("p"))
           .filter("p.k = 'log'").select("id", "p.v").collect()}
    assert ids(find_similar(boats, "boat", None, [LOG], log["b1"])) == ["b1", "b2"]
    assert in_order(find_similar(boats, "boat", "b1", [LOG], log["b1"])) == ["b2"]
    assert in_order(find_similar(boats, "boat", "b3", [LOG], log["b3"])) == []


def test_similar_with_few_terms(boats):
    """More words than a server would select by default: all of them count unless a number is given."""
    like = "lighthouse " + " ".join(["calm water the crew painted deck and mended two sails"] * 2)
    assert ids(find_similar(boats, "boat", None, [LOG], like)) == ["b1", "b2"]
    assert ids(find_similar(boats, "boat", None, [LOG], "lighthouse the", max_terms=1)) == ["b3"]


@pytest.mark.parametrize("sort,want", [("properties.built:desc", ALL[::-1]), ("properties.built:asc", ALL),
                                       ("properties.skipper.age", ALL[::-1])])
def test_sort_by_property(boats, sort, want):
    assert in_order(take_page(boats, Page(sort=sort))) == want


def test_without_stored_words(boats):
    """The same answers when the pairs hold no analysed words."""
    plain = boats.withColumn("properties", F.transform("properties", lambda p: F.struct(
        p["k"].alias("k"), p["v"].alias("v"), p["vn"].alias("vn"))))
    for query in (Q.term(NAME, "Petra"), Q.text("deck"), Q.exists(AGE), Q.range(NAME, "nadia", "omar"),
                  Q.fuzzy(LOG, "lihgthouse"), Q.range(AGE, 42, 60)):
        assert hits(plain, query) == hits(boats, query)


def test_properties_are_read_only_where_they_are_asked_for(spark):
    rows = spark.createDataFrame([("x", "a", "boat", '{"k": 1}')], "id string, appid string, type string, properties string")
    docs = normalize(rows)
    plan = find.find_by_id(docs, "x").select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "variant" not in plan


def test_integers_are_compared_exactly(spark):
    big = 1 << 53
    rows = spark.createDataFrame([(str(i), "a", big + i, f'{{"n": {big + i}}}') for i in range(3)],
                                 "id string, appid string, size bigint, properties string")
    docs = normalize(rows)
    for query in (Q.text(str(big + 1)), Q.term("properties.n", str(big + 1)), Q.term("size", str(big + 1)),
                  Q.range("properties.n", big + 1, big + 1)):
        assert ids(find.find_query(docs, None, query)) == ["1"]


@pytest.mark.parametrize("levels", [1, 7, 12, 30])
def test_properties_of_any_depth(spark, levels):
    inner = '{"n": 7, "s": "deep \\"{[ word"}'
    for i in range(levels):
        inner = f"[{inner}]" if i % 5 == 4 else f'{{"p{i}": {inner}}}'
    rows = spark.createDataFrame([("x", "a", f'{{"top": {inner}}}')], "id string, appid string, properties string")
    keys = [("0" if i % 5 == 4 else f"p{i}") for i in reversed(range(levels))]
    name = "properties." + ".".join(["top", *keys])
    docs = normalize(rows)
    assert ids(find.find_query(docs, None, Q.range(name + ".n", 7, 7) & Q.term(name + ".s", "word"))) == ["x"]


def test_flattened_once(spark):
    """Several conditions on the pairs share one flattening, and a sort does not evaluate them at each comparison."""
    rows = spark.createDataFrame([(str(i), "a", f'{{"n": {i % 3}, "m": {{"k": "x {i}"}}}}') for i in range(9)],
                                 "id string, appid string, properties string")
    docs = normalize(rows)
    found = find.find_query(docs, None, Q.term("properties.n", 1) & Q.term("properties.m.k", "x"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("try_parse_json") == docs._jdf.queryExecution(
        ).optimizedPlan().toString().count("try_parse_json")
    assert ids(found) == ["1", "4", "7"]
    page = take_page(docs, Page(limit=4, sort="properties.n:desc, id:desc"))
    plan = page._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and not any("array_max" in line for line in sorts)
    assert page.columns == docs.columns and in_order(page) == ["8", "5", "2", "7"]


def test_names_on_pairs_that_are_not_analysed(spark):
    rows = spark.createDataFrame([("1", "a", '{"Steps": [{"Year": 5}], "steps": {"yearly": 6}}'), ("2", "a", '{"year": 5, "x": "b.c"}')],
                                 "id string, appid string, properties string")
    for tree in (Q.term("properties.steps.year", 5), Q.term("properties.steps[0].year", 5), Q.term("properties.year", 5),
                 Q.term("properties.!!", 5), Q.exists("properties.steps"), Q.term("properties.x", "b.c"), Q.range("properties.year", 5, 6)):
        plain, typed = (ids(find.find_query(normalize(rows, analysed=a), None, tree)) for a in (False, True))
        assert plain == typed, tree


def test_depth_by_the_number_of_brackets(spark):
    from docsift.functions.props import depth_of
    rows = spark.createDataFrame([('{"a": {"b": [1]}}',), ('{"a": [[], [], [], [], [], [], [], [], []]}',)], "j string")
    assert depth_of(rows, F.col("j")) == 3  # few brackets: their number; many: how deep they lie
    plan_rows = rows.limit(1)
    assert depth_of(plan_rows, F.col("j")) >= 3

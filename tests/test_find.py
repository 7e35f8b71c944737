"""The rules of the lookups on a handful of users, addresses and notes."""

import re

import pytest
from conftest import NOTE_1, ids, in_order
from pyspark.sql import functions as F

from docsift.operators import counts, find
from docsift.operators.nearby import find_nearby
from docsift.operators.relevance import find_similar
from docsift.plans import paging
from docsift.plans.paging import Page, deep_page, last_key, take_page
from docsift.plans.predicates import Q


def n(df):
    return df.count()


def test_by_id(people):
    assert ids(find.find_by_id(people, "u-bo")) == ["u-bo"]
    for blank in ("", "  ", None):
        assert n(find.find_by_id(people, blank)) == 0


def test_by_ids(people, spark):
    assert ids(find.find_by_ids(people, ["n2", None, "hall", "nobody"])) == ["hall", "n2"]
    assert n(find.find_by_ids(people, [])) == n(find.find_by_ids(people, None)) == 0
    keys = spark.createDataFrame([("shelf",), ("shelf",), ("nobody",), (None,)], "k string")
    assert ids(find.find_by_ids(people, keys)) == ["shelf"]


@pytest.mark.parametrize("tags,want", [
    (["tea"], ["u-ada", "u-bo", "u-cyra"]), (["tea", "piano"], ["u-bo", "u-cyra"]), (["hiking", "chess"], ["u-ada"]),
    (["rowing", "chess"], []), (None, []), ([], [])])
def test_every_tag_is_wanted(people, tags, want):
    assert ids(find.find_tagged(people, "user", tags)) == want
    assert ids(find.find_tagged(people, "note", tags)) == []


def test_tags_by_keyword(people):
    for keyword, count in [("t", 1), ("t?a", 1), ("coffee", 0), (" ", 0), (None, 0)]:
        assert n(find.find_tags(people, keyword)) == count


def test_term_in_list(people, spark):
    f = find.find_term_in_list
    assert ids(f(people, "user", "email", ["bo@lake.example", "nobody@lake.example"])) == ["u-bo"]
    assert ids(f(people, None, "id", ["home", "u-ada", "nobody"])) == ["home", "u-ada"]
    for field, terms in [("id", []), ("id", None), ("", ["home"]), ("id", [None])]:
        assert n(f(people, None, field, terms)) == 0
    keys = spark.createDataFrame([("cyra@hill.example",)], "k string")
    assert ids(f(people, "user", "identifier", keys)) == ["u-cyra"]


def test_terms(people):
    f = find.find_terms
    assert ids(f(people, "user", {"name": "Bo Ferrant"})) == ["u-bo"]
    both = {"name": "Bo Ferrant", "id": "u-ada"}
    assert ids(f(people, "user", both)) == []
    assert ids(f(people, "user", both, False)) == ["u-ada", "u-bo"]
    for unusable in (None, {}, {" ": "x"}, {"": "x"}, {"id": None}, {"id": " "}, {"id": ["u-ada"]}):
        assert n(f(people, "user", unusable)) == 0
    assert ids(f(people, "user", {"timestamp <": 946684800001})) == ["u-ada"]
    assert ids(f(people, "user", {"timestamp<=": "2000-01-01"})) == ["u-ada"]
    assert ids(f(people, "user", {"timestamp >": "2000/01/01", "email": " "})) == ["u-bo", "u-cyra"]


def test_numbers_must_be_numbers(people):
    for terms in ({"count": "a dozen"}, {"nosuch": "3"}):
        with pytest.raises(ValueError):
            find.find_terms(people, "tag", terms)
    assert ids(find.find_terms(people, "tag", {"count": "12"})) == ["tag:tea"]


def test_prefix_and_wildcard(people):
    assert ids(find.find_prefix(people, "user", "name", "Cy")) == ["u-cyra"]
    assert n(find.find_prefix(people, "user", "name", "cy")) == 0
    assert n(find.find_prefix(people, "user", "name", "")) == 0
    for pattern, want in [("B*", ["u-bo"]), ("A?a Quill", ["u-ada"]), ("*M*s", ["u-cyra"]), ("B\\*", []), ("b*", [])]:
        assert ids(find.find_wildcard(people, "user", "name", pattern)) == want
    assert ids(find.find_wildcard(people, "user", "identifier", "*@lake.*")) == ["u-ada", "u-bo"]
    assert n(find.find_wildcard(people, "user", None, "x")) == 0


def test_nested_objects(people):
    f = find.find_nested_query
    for word in ("teapot", "kettle"):
        hit = f(people, "record", "properties.text", word)
        assert ids(hit) == ["shelf"] and len(hit.first()["nstd"]) == 2
    assert n(f(people, "record", "properties.text", "cup")) == 0
    assert n(f(people, "record", "properties.text", "*")) == 1
    assert n(f(people, "record", "", "teapot")) == 0
    for name, count in [("o1", 0), ("o2", 1)]:  # both conditions in one object
        tree = Q.term("id", name) & Q.term("properties.text", "kettle")
        assert n(f(people, "record", None, tree)) == count


def test_query(people):
    f = find.find_query
    assert n(f(people, "user", "*")) == 3
    assert n(f(people, "user", None)) == n(f(people, "user", " ")) == 0
    assert ids(f(people, None, "_ferry")) == []
    assert ids(f(people, "user", "Ada Quill")) == ["u-ada"]
    assert ids(f(people, "user", "piano")) == ["u-bo", "u-cyra"]
    assert ids(f(people, "note", "Noon")) == ["n1", "n2"]
    assert ids(f(people, "user", Q.where(lambda: F.length("name") > 9))) == ["u-bo"]


@pytest.mark.parametrize("text", ["type:user", "Ann*", "a AND b", "+tea -piano", '"green teapot"', "tea~", "(tea)",
                                  "[1 TO 2]", "te?"])
def test_query_strings_are_refused(people, text):
    with pytest.raises(ValueError):
        find.find_query(people, "user", text)


def test_nearby(people):
    at = (47.40, 8.50)
    assert ids(find_nearby(people, "address", "*", 6, *at)) == ["home"]
    assert ids(find_nearby(people, "address", "*", 25, *at)) == ["hall", "home"]
    assert ids(find_nearby(people, "user", "*", 25, *at)) == ["u-ada"]
    assert ids(find_nearby(people, "tag", None, 25, *at)) == ["tag:tea"]
    assert n(find_nearby(people, "user", Q.term("name", "Bo Ferrant"), 25, *at)) == 0
    assert n(find_nearby(people, None, "*", 25, *at)) == 0
    assert ids(find_nearby(people, "address", "*", 6, 47.40, 8.50 + 360)) == ["home"]


def test_similar(people):
    hits = find_similar(people, "note", "n1", ["properties.text"], NOTE_1).orderBy(F.desc("score"))
    assert in_order(hits) == ["n2"]
    for like in ("", None):
        assert n(find_similar(people, "note", "", ["properties.text"], like)) == 0


def test_counts(people):
    def value(df):
        return df.first()["count"]
    assert value(counts.get_count(people)) == 9
    assert [value(counts.get_count(people, t)) for t in ("user", "note", "nosuch")] == [3, 2, 0]
    assert [value(counts.get_count_terms(people, "user", t)) for t in ({"id": " "}, {"id": "u-bo"}, None)] == [0, 1, 0]
    assert [counts.total_hits(people, *cap).first()["total"] for cap in ((), (4,), (40,))] == [9, 4, 9]
    by_type = {r["type"]: r["count"] for r in counts.count_by_type(people).collect()}
    assert by_type == {"user": 3, "tag": 1, "address": 2, "note": 2, "record": 1}


def test_pages(people):
    users = find.scope(people, type="user")
    sizes = [n(take_page(users, Page(number=p, limit=2, sort="id", desc=False))) for p in (1, 2, 3)]
    assert sizes == [2, 1, 0]
    for sort, want in [("id", ["u-ada", "u-bo", "u-cyra"]), ("id:desc", ["u-cyra", "u-bo", "u-ada"]),
                       ("timestamp:desc, name:asc", ["u-bo", "u-cyra", "u-ada"])]:
        assert in_order(take_page(users, Page(sort=sort, desc=False))) == want
    beyond = Page(number=9, limit=2, sort="id", desc=False, max_pages=5)
    assert in_order(take_page(users, beyond)) == ["u-ada", "u-bo"]


def test_missing_values_sort_last(people):
    for direction in ("asc", "desc"):
        rows = take_page(people, Page(limit=9, sort=f"email:{direction}")).collect()
        assert [r["email"] is None for r in rows] == [False] * 3 + [True] * 6


@pytest.mark.parametrize("desc", [False, True])
def test_search_after(spark, desc):
    from docsift.operators.normalize import normalize
    docs = normalize(spark.range(25).selectExpr("'app' AS appid", "'d' || id AS id"))
    page, seen, sizes = Page(limit=9, desc=desc, sort="_docid"), [], []
    for _ in range(4):
        rows = take_page(docs, page).cache()
        sizes.append(rows.count())
        seen += in_order(rows)
        page = Page(limit=9, desc=desc, sort="_docid", last_key=last_key(rows, desc))
        if sizes[-1] == 0:
            break
    assert sizes == [9, 9, 7, 0]
    whole = docs.orderBy(F.desc("_docid") if desc else F.asc("_docid"))
    assert seen == in_order(whole)


def test_tenant_scope(spark):
    docs = spark.createDataFrame([("d1", "north"), ("d2", " south"), ("d3", "north")],
                                 "id string, appid string")
    assert ids(find.scope(docs, "north")) == ["d1", "d3"]
    assert ids(find.scope(docs, " south")) == ["d2"]  # the id is not trimmed
    assert ids(find.scope(docs, "south")) == []


def test_deep_pages(spark, monkeypatch):
    """Every page through the ranges is the page of a full sort; ties, nulls and the end included."""
    rows = [(i, None if i % 17 == 0 else i % 7, f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, rank int, note string").repartition(5)
    for sort in ("rank:desc", "rank:asc", "note:asc", ""):
        whole = in_order(take_page(df, Page(limit=500, sort=sort)))
        for number, limit in ((1, 10), (2, 10), (33, 10), (50, 10), (51, 10), (7, 70), (8, 70), (9, 70), (2, 499)):
            page = Page(number=number, limit=limit, sort=sort)
            got = in_order(deep_page(df, page, parts=9))
            assert got == whole[(number - 1) * limit:number * limit], (sort, number, limit)
    monkeypatch.setattr(paging, "DEEP_ROWS", 50)
    assert in_order(take_page(df, Page(number=40, limit=10, sort="rank:asc"))) == in_order(
        take_page(df, Page(limit=500, sort="rank:asc")))[390:400]
    assert in_order(take_page(df.limit(0), Page(number=40, limit=10))) == []


def test_a_deep_page_sorts_few_rows(spark):
    df = spark.range(20_000).selectExpr("id", "(id * 7919) % 20011 AS v")
    page = deep_page(df, Page(number=150, limit=100, sort="v:asc"), parts=40)
    assert in_order(page) == [r[0] for r in df.orderBy("v", "id").select("id").collect()][14_900:15_000]
    plan = page._jdf.queryExecution().executedPlan().toString()
    chosen = re.search(r"PushedFilters: \[[^\n]*?(?:In|EqualTo)\(_range,\s?\[?([\d,]+)", plan)[1].split(",")
    assert 1 <= len(chosen) <= 2

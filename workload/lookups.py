"""Lookups, predicates, sorting, paging and counts on plain columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators import counts, find
from docsift.plans.paging import Page, deep_page, last_key, take_page
from docsift.plans.predicates import Q
from workload.common import (EVENTS_SQL, MAPPING, customers, events, orders, parts, query, table,
                             words)


@query("find_by_id", """SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total
 FROM orders WHERE o_orderkey = 77""")
def find_by_id(spark, sf):
    return find.find_by_id(orders(spark, sf), "77").select("id", "status", "total")


@query("find_by_ids", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""")
def find_by_ids(spark, sf):
    large = table(spark, sf, "lineitem").filter("l_quantity >= 49").select("l_orderkey")
    return find.find_by_ids(orders(spark, sf), large).select("id", "total")


@query("find_by_id_list", "SELECT o_orderkey AS id, o_totalprice AS total FROM orders WHERE o_orderkey IN (7, 33, 77)")
def find_by_id_list(spark, sf):
    return find.find_by_ids(orders(spark, sf), ["33", None, "77", "7"]).select("id", "total")


@query("find_terms_in_table", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def find_terms_in_table(spark, sf):
    rich = table(spark, sf, "customer").filter("c_acctbal > 9000").select("c_custkey")
    return find.find_term_in_list(orders(spark, sf), None, "creatorid", rich,
                                  MAPPING).select("id", "total")


@query("find_term_in_list", """SELECT c_custkey AS id, c_name AS name FROM customer
 WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def find_term_in_list(spark, sf):
    return find.find_term_in_list(customers(spark, sf), None, "type",
                                  ["BUILDING", "MACHINERY"]).select("id", "name")


@query("find_prefix", """SELECT p_partkey AS id, p_name AS name FROM part
 WHERE starts_with(p_name, 'small')""")
def find_prefix(spark, sf):
    return find.find_prefix(parts(spark, sf), None, "name", "small").select("id", "name")


@query("find_wildcard", """SELECT p_partkey AS id, p_name AS name FROM part
 WHERE p_name LIKE '%e w_dg%'""")
def find_wildcard(spark, sf):
    return find.find_wildcard(parts(spark, sf), None, "name", "*e w?dg*").select("id", "name")


@query("find_tagged", """SELECT p_partkey AS id, p_name AS name FROM part
 WHERE list_contains(string_split(p_name, ' ') || [lower(p_type)], 'red')
   AND list_contains(string_split(p_name, ' ') || [lower(p_type)], 'economy')""")
def find_tagged(spark, sf):
    return find.find_tagged(parts(spark, sf), None, ["red", "economy"]).select("id", "name")


@query("find_tags", """SELECT DISTINCT tag FROM (
 SELECT unnest(string_split(p_name, ' ') || [lower(p_type)]) AS tag FROM part)
 WHERE tag LIKE 's%'""")
def find_tags(spark, sf):
    tags = (parts(spark, sf).select(F.explode("tags").alias("tag")).distinct()
            .select("tag", F.lit("tag").alias("type")))
    return find.find_tags(tags, "s").select("tag")


@query("find_terms_all", """SELECT p_partkey AS id, p_brand AS brand, p_size AS size FROM part
 WHERE p_type = 'PROMO' AND p_size >= 20 AND p_brand = 'Brand#4'""")
def find_terms_all(spark, sf):
    terms = {"type": "PROMO", "size >=": 20, "brand": "Brand#4", "name": " ", "price": None}
    return find.find_terms(parts(spark, sf), None, terms, True, MAPPING).select("id", "brand", "size")


@query("find_terms_any", """SELECT p_partkey AS id, p_brand AS brand, p_size AS size FROM part
 WHERE p_type = 'PROMO' OR p_size = 7 OR p_brand = 'Brand#4'""")
def find_terms_any(spark, sf):
    terms = {"type": "PROMO", "size": "7", "brand": "Brand#4"}
    return find.find_terms(parts(spark, sf), None, terms, False, MAPPING).select("id", "brand", "size")


@query("find_terms_range", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 WHERE o_totalprice > 400000 AND o_orderdate <= TIMESTAMP '1997-06-30'""")
def find_terms_range(spark, sf):
    terms = {"total >": 400000, "timestamp <=": "1997-06-30"}
    return find.find_terms(orders(spark, sf), None, terms, True, MAPPING).select("id", "total")


@query("tenant_scope", f"""SELECT id, creatorid, value FROM ({EVENTS_SQL})
 WHERE appid = 'u3' AND type = 'purchase'""")
def tenant_scope(spark, sf):
    return find.scope(events(spark, sf), "u3", "purchase").select("id", "creatorid", "value")


@query("query_bool", """SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total
 FROM orders WHERE o_totalprice >= 300000 AND o_orderstatus IN ('F', 'O')""")
def query_bool(spark, sf):
    # the inner `should` is optional beside a `must`; the second group needs one of its two
    tree = Q.bool(
        must=[Q.bool(must=[Q.range("total", 300000, "*")], should=[Q.term("priority", "1-URGENT")]),
              Q.bool(should=[Q.term("status", "F"), Q.term("status", "O")])])
    return find.find_query(orders(spark, sf), "order", tree, MAPPING).select("id", "status", "total")


@query("query_must_not", """SELECT c_custkey AS id, c_acctbal AS balance FROM customer
 WHERE NOT (c_mktsegment = 'BUILDING') AND NOT (c_acctbal < 0)""")
def query_must_not(spark, sf):
    tree = Q.bool(must_not=[Q.term("type", "BUILDING"),
                            Q.range("balance", "*", 0, include_high=False)])
    return find.find_query(customers(spark, sf), None, tree).select("id", "balance")


@query("query_range", """SELECT o_orderkey AS id FROM orders
 WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
   AND o_totalprice > 1000 AND o_totalprice <= 250000""")
def query_range(spark, sf):
    tree = (Q.range("timestamp", "1996/01/01", "1997-01-01 00:00:00", include_high=False)
            & Q.range("total", "1000", "250000", include_low=False))
    return find.find_query(orders(spark, sf), "order", tree, MAPPING).select("id")


@query("query_match_all", "SELECT p_partkey AS id FROM part WHERE p_type = 'PROMO'")
def query_match_all(spark, sf):
    return find.find_query(parts(spark, sf), "PROMO", "*").select("id")


@query("query_where", "SELECT p_partkey AS id FROM part WHERE p_size * 2 > p_retailprice / 25")
def query_where(spark, sf):
    tree = Q.where(lambda: F.col("size") * 2 > F.col("price") / 25)
    return find.find_query(parts(spark, sf), None, tree).select("id")


BIG = "CAST(o_orderkey AS BIGINT) + 9007199254740992"


@query("query_big_ids", f"""SELECT {BIG} AS id FROM orders
 WHERE {BIG} IN (9007199254740993, 9007199254741069)""")
def query_big_ids(spark, sf):
    """Integers that doubles can't tell apart."""
    docs = orders(spark, sf).withColumn("id", F.col("id") + 9007199254740992)
    tree = Q.text("9007199254740993") | Q.term("id", "9007199254741069")
    return find.find_query(docs, "order", tree, MAPPING).select("id")


@query("query_free_text", """SELECT p_partkey AS id, p_name AS name FROM part
 WHERE list_contains(string_split(p_name, ' '), 'gear') OR p_name = 'red gear'
    OR list_contains(string_split(p_name, ' '), 'red')""")
def query_free_text(spark, sf):
    return find.find_query(parts(spark, sf), None, "red gear", MAPPING).select("id", "name")


@query("query_free_text_documents", f"""SELECT doc_id AS id, lang FROM documents
 WHERE list_has_any({words('text')}, {words("'License anou ORDER'")}) OR lang = 'x' OR source = 'x'""")
def query_free_text_documents(spark, sf):
    docs = table(spark, sf, "documents", spread=True).withColumnRenamed("doc_id", "id")
    return find.find_query(docs, None, "License anou ORDER", MAPPING.plus("lang", "source")).select(
        "id", "lang")


@query("query_fuzzy", """SELECT p_partkey AS id, p_name AS name FROM part
 WHERE len(list_filter(string_split(p_name, ' '), lambda t: damerau_levenshtein(t, 'widgte') <= 2)) > 0""")
def query_fuzzy(spark, sf):
    return find.find_query(parts(spark, sf), None, Q.fuzzy("title", "widgte"), MAPPING).select(
        "id", "name")


@query("query_prefix_any_field", """SELECT p_partkey AS id FROM part
 WHERE p_name = 'red gear' OR list_has_any(string_split(p_name, ' '), ['red', 'gear'])
  OR list_contains(string_split(p_name, ' '), 'red gear')""")
def query_prefix_any_field(spark, sf):
    """Without a field a prefix is compared with plain fields as it stands."""
    return find.find_query(parts(spark, sf), None, Q.prefix(None, "red gear"), MAPPING).select("id")


@query("query_wildcard_any_field", "SELECT p_partkey AS id FROM part WHERE false")
def query_wildcard_any_field(spark, sf):
    return find.find_query(parts(spark, sf), None, Q.wildcard(None, "r?d*"), MAPPING).select("id")


@query("query_fuzzy_any_field", """SELECT p_partkey AS id FROM part
 WHERE list_contains(string_split(p_name, ' '), 'gear')""")
def query_fuzzy_any_field(spark, sf):
    return find.find_query(parts(spark, sf), None, Q.fuzzy(None, "gear"), MAPPING).select("id")


PAGE = 200


@query("sort_multi", f"""SELECT id, type, balance, CAST(row_number() OVER () AS INT) AS rank FROM (
 SELECT c_custkey AS id, c_mktsegment AS type, c_acctbal AS balance FROM customer
 ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey ASC LIMIT {PAGE})""")
def sort_multi(spark, sf):
    page = take_page(customers(spark, sf), Page(limit=PAGE, sort="type:asc, balance:desc"))
    return ranked(page.select("id", "type", "balance"), F.asc("type"), F.desc("balance"))


def ranked(page, *order):
    """Number the rows of one page; a page has at most its limit of rows."""
    from pyspark.sql import Window
    return page.withColumn("rank", F.row_number().over(Window.orderBy(*order, F.asc("id"))))


@query("page_number", f"""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
 ORDER BY c_acctbal DESC, c_custkey LIMIT {PAGE} OFFSET {2 * PAGE}""")
def page_number(spark, sf):
    page = Page(number=3, limit=PAGE, sort="balance")
    return take_page(customers(spark, sf), page).select("id", "name", "balance")


@query("search_after", f"""SELECT event_id AS id, (event_id * 7919) % 100003 AS _docid FROM events
 ORDER BY _docid ASC, id ASC LIMIT {PAGE} OFFSET {PAGE}""")
def search_after(spark, sf):
    docs = events(spark, sf).withColumn("_docid", F.col("id") * 7919 % 100003).select("id", "_docid")
    first = take_page(docs, Page(limit=PAGE, sort="_docid", desc=False))
    return take_page(docs, Page(limit=PAGE, desc=False, last_key=last_key(first, desc=False)))


@query("count_by_type", f"SELECT appid, type, count(*) AS count FROM ({EVENTS_SQL}) GROUP BY ALL")
def count_by_type(spark, sf):
    return counts.count_by_type(events(spark, sf))


@query("count_type", "SELECT count(*) AS count FROM events WHERE event_type = 'click'")
def count_type(spark, sf):
    return counts.get_count(events(spark, sf), "click")


@query("count_terms", """SELECT count(*) AS count FROM events
 WHERE event_type = 'click' AND value >= 50 AND user_id = 7""")
def count_terms(spark, sf):
    return counts.get_count_terms(events(spark, sf), "click", {"value >=": 50, "creatorid": 7})


@query("total_hits", "SELECT count(*) AS total FROM events WHERE value > 10")
def total_hits(spark, sf):
    return counts.total_hits(find.find_terms(events(spark, sf), None, {"value >": 10}))


@query("total_hits_capped", """SELECT least(count(*), 1000) AS total FROM events WHERE value > 10""")
def total_hits_capped(spark, sf):
    return counts.total_hits(find.find_terms(events(spark, sf), None, {"value >": 10}), cap=1000)


@query("page_deep", """SELECT id, total, CAST(row_number() OVER (ORDER BY total DESC, id) AS INT) AS rank FROM (
 SELECT l_orderkey * 10 + l_linenumber AS id, l_extendedprice AS total FROM lineitem
 ORDER BY total DESC, id LIMIT 5 OFFSET 49995)""")
def page_deep(spark, sf):
    """Page 10,000, found by the ranks of the ranges before it."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_extendedprice").alias("total"))
    page = deep_page(lines, Page(number=10_000, limit=5, sort="total:desc"))
    return ranked(page, F.desc("total"), F.asc("id"))

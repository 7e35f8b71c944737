"""Dynamic properties and nested objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators import find
from docsift.operators.normalize import normalize, property_rows, restore
from docsift.operators.propindex import write_index
from docsift.plans.paging import Page, take_page
from docsift.plans.predicates import Q
from docsift.session import scratch_path
from workload.common import ORDER_PROPERTIES, order_documents, query, table

DAY = "%Y-%m-%d %H:%M:%S"


@query("flatten_properties", """SELECT event_id AS id, 'k' AS k, CAST(NULL AS VARCHAR) AS v,
 CAST(json_extract(props, '$.k') AS DOUBLE) AS vn FROM events""")
def flatten_properties(spark, sf):
    rows = table(spark, sf, "events", spread=True).withColumnRenamed("event_id", "id")
    return property_rows(rows, "props", ["id"])


ORDER_LEAVES = """
 SELECT o_orderkey AS id, 'status' AS k, o_orderstatus AS v, CAST(NULL AS DOUBLE) AS vn FROM orders
 UNION ALL SELECT o_orderkey, 'total', NULL, o_totalprice FROM orders
 UNION ALL SELECT o_orderkey, 'customer-id', NULL, CAST(o_custkey AS DOUBLE) FROM orders
 UNION ALL SELECT o_orderkey, 'customer-band', 'band ' || CAST(o_custkey % 7 AS VARCHAR), NULL FROM orders
 UNION ALL SELECT o_orderkey, 'marks-0', o_orderstatus, NULL FROM orders
 UNION ALL SELECT o_orderkey, 'marks-1', o_orderpriority, NULL FROM orders
 UNION ALL SELECT o_orderkey, 'steps-0-code', o_orderstatus, NULL FROM orders
 UNION ALL SELECT o_orderkey, 'steps-0-year', NULL, CAST(year(o_orderdate) AS DOUBLE) FROM orders
 UNION ALL SELECT o_orderkey, 'steps-1-code', o_orderpriority, NULL FROM orders
 UNION ALL SELECT o_orderkey, 'steps-1-year', NULL, CAST(year(o_orderdate) + 1 AS DOUBLE) FROM orders"""


@query("flatten_deep", ORDER_LEAVES)
def flatten_deep(spark, sf):
    rows = table(spark, sf, "orders", spread=True).select(
        F.col("o_orderkey").alias("id"), F.expr(ORDER_PROPERTIES).alias("json"))
    return property_rows(rows, "json", ["id"])


LEVELS = 13


def _deep(spark, sf):
    """The order's key and status at the bottom of many nested objects and arrays."""
    node = "named_struct('n', o_orderkey, 's', o_orderstatus)"
    for level in range(LEVELS - 1):
        node = f"array({node})" if level % 4 == 3 else f"named_struct('l{level}', {node})"
    return table(spark, sf, "orders", spread=True).select(
        F.col("o_orderkey").alias("id"), F.lit("a").alias("appid"), F.expr(f"to_json(named_struct('top', {node}))")
        .alias("properties"))


def _deep_key() -> str:
    steps = ["0" if level % 4 == 3 else f"l{level}" for level in reversed(range(LEVELS - 1))]
    return "-".join(["top", *steps])


@query("flatten_deepest", f"""SELECT o_orderkey AS id, '{_deep_key()}-n' AS k, CAST(NULL AS VARCHAR) AS v,
  CAST(o_orderkey AS DOUBLE) AS vn FROM orders
 UNION ALL SELECT o_orderkey, '{_deep_key()}-s', o_orderstatus, NULL FROM orders""")
def flatten_deepest(spark, sf):
    return property_rows(_deep(spark, sf), "properties", ["id"])


@query("nested_deepest", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey >= 500 AND o_orderstatus = 'F'")
def nested_deepest(spark, sf):
    key = "properties." + _deep_key().replace("-", ".")
    tree = Q.range(key + ".n", 500, "*") & Q.term(key + ".s", "f")
    return find.find_query(normalize(_deep(spark, sf)), None, tree).select("id")


@query("nested_terms_in_table", """SELECT o_orderkey AS id FROM orders
 WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""")
def nested_terms_in_table(spark, sf):
    rich = table(spark, sf, "customer").filter("c_acctbal > 9000").select("c_custkey")
    docs = normalize(order_documents(spark, sf))
    return find.find_term_in_list(docs, "order", "properties.customer.id", rich).select("id")


@query("nested_big_numbers", """SELECT o_orderkey AS id FROM orders WHERE o_orderkey IN (1, 77)""")
def nested_big_numbers(spark, sf):
    rows = table(spark, sf, "orders", spread=True).select(
        F.col("o_orderkey").alias("id"), F.lit("a").alias("appid"),
        F.to_json(F.struct((F.col("o_orderkey") + 9007199254740992).alias("n"))).alias("properties"))
    tree = Q.term("properties.n", "9007199254740993") | Q.range("properties:n", 9007199254741069, 9007199254741069)
    return find.find_query(normalize(rows), None, tree).select("id")


@query("normalize_documents", f"""SELECT id, strftime(t, '{DAY}') AS at, k, vn FROM (
 SELECT event_id AS id, 'k' AS k, CAST(json_extract(props, '$.k') AS DOUBLE) AS vn,
  CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
   WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('day', ts)
   ELSE TIMESTAMP '1970-01-01' + to_milliseconds(CAST(strftime(ts, '%Y%m%d') AS BIGINT)) END AS t
 FROM events)""")
def normalize_documents(spark, sf):
    """Dates in five spellings; the all-digit day is read as milliseconds, by the order of formats."""
    ts = F.col("ts").cast("timestamp")
    text = (F.when(F.col("event_id") % 5 == 0, F.unix_millis(ts).cast("string"))
            .when(F.col("event_id") % 5 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_id") % 5 == 2, F.date_format(ts, "yyyy-MM-dd"))
            .when(F.col("event_id") % 5 == 3, F.date_format(ts, "yyyy/MM/dd"))
            .otherwise(F.date_format(ts, "yyyyMMdd")))
    rows = table(spark, sf, "events", spread=True).select(
        F.col("event_id").alias("id"), F.lit("a").alias("appid"), text.alias("timestamp"),
        F.col("props").alias("properties"), F.col("props").alias("settings"))
    docs = normalize(rows)
    return docs.select("id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"),
                       F.explode("properties").alias("p")).select("id", "at", "p.k", "p.vn")


@query("restore_properties", """SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total,
 'band ' || CAST(o_custkey % 7 AS VARCHAR) AS band, year(o_orderdate) + 1 AS next_year FROM orders""")
def restore_properties(spark, sf):
    back = restore(normalize(order_documents(spark, sf)))
    value = lambda path, kind: F.variant_get("properties", path, kind)
    return back.select(
        "id", value("$.status", "string").alias("status"), value("$.total", "double").alias("total"),
        value("$.customer.band", "string").alias("band"),
        value("$.steps[1].year", "bigint").alias("next_year"))


def _read_once(spark, sf):
    """The orders for a single pass: words are looked for where a key fits, and not of all pairs beforehand."""
    return normalize(order_documents(spark, sf), analysed=False)


def _hits(spark, sf, tree):
    return find.find_query(_read_once(spark, sf), "order", tree).select("id")


def _orders_where(condition: str) -> str:
    return f"SELECT o_orderkey AS id FROM orders WHERE {condition}"


@query("nested_term", _orders_where(
    "o_orderpriority = '1-URGENT' AND o_custkey % 7 = 3 AND o_custkey = 10"))
def nested_term(spark, sf):
    return _hits(spark, sf, Q.bool(must=[Q.term("properties.marks", "urgent"),
                                         Q.term("properties.customer.band", "Band 3"),
                                         Q.term("properties.customer.id", "10")]))


@query("nested_term_in_list", _orders_where(
    "o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW' OR o_orderstatus = 'P'"))
def nested_term_in_list(spark, sf):
    docs = _read_once(spark, sf)
    return find.find_term_in_list(docs, "order", "properties.marks",
                                  ["urgent", "low", "p"]).select("id")


@query("nested_range", _orders_where("o_totalprice >= 400000 AND year(o_orderdate) < 1997"))
def nested_range(spark, sf):
    docs = _read_once(spark, sf)
    return find.find_terms(docs, "order", {"properties.total >=": 400000,
                                           "properties.steps[0].year <": 1997}).select("id")


@query("nested_exists", """SELECT event_id AS id FROM events
 WHERE json_extract(props, '$.k') IS NOT NULL""")
def nested_exists(spark, sf):
    rows = table(spark, sf, "events", spread=True).select(
        F.col("event_id").alias("id"), F.lit("a").alias("appid"), F.col("props").alias("properties"))
    return find.find_query(normalize(rows), None, Q.exists("properties.k")).select("id")


@query("nested_prefix", _orders_where("o_orderpriority LIKE '%-URG%' OR o_orderpriority LIKE '%-HI%'"))
def nested_prefix(spark, sf):
    return _hits(spark, sf, Q.prefix("properties.steps.code", "urg")
                 | Q.prefix("properties.steps.code", "hi"))


@query("nested_wildcard", _orders_where("o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')"))
def nested_wildcard(spark, sf):
    return _hits(spark, sf, Q.wildcard("properties.marks", "?edium")
                 | Q.wildcard("properties.marks", "spec*ed"))


@query("nested_fuzzy", _orders_where("o_orderpriority = '1-URGENT'"))
def nested_fuzzy(spark, sf):
    return _hits(spark, sf, Q.fuzzy("properties.marks", "ugrentt"))


@query("nested_array_pin", _orders_where("o_orderstatus = 'F' AND year(o_orderdate) + 1 = 1998"))
def nested_array_pin(spark, sf):
    return _hits(spark, sf, Q.term("properties.marks[0]", "f")
                 & Q.term("properties.steps[1].year", 1998))


@query("nested_text_range", _orders_where("o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')"))
def nested_text_range(spark, sf):
    return _hits(spark, sf, Q.range("properties.marks[1]", "not", "urgent"))


@query("nested_free_text", _orders_where("o_orderpriority = '5-LOW' OR year(o_orderdate) = 1999 "
                                         "OR year(o_orderdate) = 1998 OR o_custkey = 1999 "
                                         "OR o_orderkey = 1999 OR o_totalprice = 1999"))
def nested_free_text(spark, sf):
    return _hits(spark, sf, Q.text("low") | Q.text("1999"))


@query("nested_must_not", _orders_where("NOT (o_totalprice <= 100000) AND NOT (o_orderstatus = 'O')"))
def nested_must_not(spark, sf):
    return _hits(spark, sf, Q.bool(must_not=[Q.range("properties.total", "*", 100000),
                                             Q.term("properties.status", "o")]))


@query("find_nested_query", """SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS quantity
 FROM lineitem WHERE (l_returnflag = 'R' AND l_quantity >= 45) OR (l_linestatus = 'R' AND l_discount * 1000 >= 45)""")
def find_nested_query(spark, sf):
    """Both conditions must hold in one and the same object."""
    docs = table(spark, sf, "lineitem").withColumn("nstd", F.array(
        F.struct(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("amount")),
        F.struct(F.col("l_linestatus").alias("flag"), (F.col("l_discount") * 1000).alias("amount"))))
    tree = Q.term("flag", "r") & Q.range("amount", 45, "*")
    return find.find_nested_query(docs, None, None, tree).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"))


@query("find_nested_text", """SELECT conv_id, turn FROM (
 SELECT conv_id, turn, unnest(string_split(text, '.')) AS line FROM conversations)
 WHERE list_contains(regexp_extract_all(lower(line), '[\\p{L}\\p{N}_]+(?:[.''’][\\p{L}\\p{N}_]+)*'), 'the')
  AND list_contains(regexp_extract_all(lower(line), '[\\p{L}\\p{N}_]+(?:[.''’][\\p{L}\\p{N}_]+)*'), 'of')
 GROUP BY ALL""")
def find_nested_text(spark, sf):
    """Both words in one and the same sentence of a turn."""
    docs = table(spark, sf, "conversations", spread=True).withColumn("nstd", F.transform(
        F.split("text", "[.]"), lambda s: F.struct(F.struct(s.alias("text")).alias("properties"))))
    tree = Q.match("properties.text", "the") & Q.match("properties.text", "of")
    return find.find_nested_query(docs, None, None, tree).select("conv_id", "turn")


@query("sort_nested_numeric", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 ORDER BY year(o_orderdate) + 1 DESC, o_totalprice ASC, o_orderkey ASC LIMIT 200""")
def sort_nested_numeric(spark, sf):
    docs = _read_once(spark, sf)
    page = take_page(docs, Page(limit=200, sort="properties.steps.year:desc, properties.total:asc"))
    return page.select("id", F.get(F.filter("properties", lambda p: p["k"] == "total"), 0)["vn"]
                       .alias("total"))


@query("nested_wildcard_any_field", "SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'")
def nested_wildcard_any_field(spark, sf):
    """Without a field a pattern reaches the words of all properties."""
    return find.find_query(_read_once(spark, sf), "order", Q.wildcard(None, "ur?en*")).select("id")


@query("nested_spellings", """SELECT o_orderkey AS id FROM orders
 WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 1995""")
def nested_spellings(spark, sf):
    """The three ways to name a property."""
    tree = (Q.term("properties:status", "f") & Q.term("order.properties.marks[1]", "urgent")
            & Q.range("properties.steps[0].year", 1995, "*"))
    return find.find_query(_read_once(spark, sf), "order", tree).select("id")


# ---------------------------------------------------------------- the stored index of properties

_indexes: dict = {}


def _index(spark, sf):
    """The orders, normalised and indexed once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = write_index(normalize(order_documents(spark, sf)), scratch_path(spark, "properties"),
                                    file_rows=500_000, group_bytes=1 << 20)
    return _indexes[key]


def _indexed(spark, sf, tree):
    return _index(spark, sf).find(Q.term("type", "order") & tree).select("id")


@query("indexed_range", _orders_where("o_totalprice >= 400000 AND year(o_orderdate) < 1997"))
def indexed_range(spark, sf):
    return _indexed(spark, sf, Q.range("properties.total", 400000, "*")
                    & Q.range("properties.steps[0].year", "*", 1997, include_high=False))


@query("indexed_term", _orders_where(
    "o_orderpriority = '1-URGENT' AND o_custkey % 7 = 3 AND o_custkey = 10"))
def indexed_term(spark, sf):
    return _indexed(spark, sf, Q.bool(must=[Q.term("properties.marks", "urgent"), Q.term("properties.customer.band", "Band 3"),
                                            Q.term("properties.customer.id", "10")]))


@query("indexed_wildcard", _orders_where("o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED')"))
def indexed_wildcard(spark, sf):
    return _indexed(spark, sf, Q.wildcard("properties.marks", "?edium") | Q.wildcard("properties.marks", "spec*ed"))


@query("indexed_fuzzy_prefix", _orders_where("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'F'"))
def indexed_fuzzy_prefix(spark, sf):
    return _indexed(spark, sf, Q.bool(
        must=[Q.fuzzy("properties.marks", "ugrentt") | Q.prefix("properties.steps.code", "hi")],
        must_not=[Q.term("properties:status", "f")]))


@query("indexed_text_range", _orders_where("o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')"))
def indexed_text_range(spark, sf):
    return _indexed(spark, sf, Q.range("properties.marks[1]", "not", "urgent"))


@query("indexed_must_not", _orders_where("NOT (o_totalprice <= 100000) AND NOT (o_orderstatus = 'O')"))
def indexed_must_not(spark, sf):
    return _indexed(spark, sf, Q.bool(must_not=[Q.range("properties.total", "*", 100000), Q.term("properties.status", "o")]))


@query("indexed_exists", _orders_where("o_orderdate IS NOT NULL AND o_orderkey > 100"))
def indexed_exists(spark, sf):
    return _indexed(spark, sf, Q.exists("properties.steps[1].year") & Q.range("id", 100, "*", include_low=False))


@query("indexed_sort", """SELECT o_orderkey AS id, o_totalprice AS total FROM orders
 ORDER BY year(o_orderdate) + 1 DESC, o_totalprice ASC, o_orderkey ASC LIMIT 200""")
def indexed_sort(spark, sf):
    index = _index(spark, sf)
    page = index.page(index.docs.select("id", "appid"), Page(
        limit=200, sort="properties.steps.year:desc, properties.total:asc"))
    return page.select("id", F.col("_by1").alias("total"))

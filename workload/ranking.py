"""Ranked search and similarity on the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.operators import postings, relevance
from docsift.operators.normalize import normalize
from docsift.plans.paging import Page, take_page
from docsift.plans.predicates import Q
from docsift.session import materialize, scratch_path
from workload.common import MAPPING, query, table, words

TEXT_MAPPING = MAPPING.plus("lang", "source")
WANTED = "the and thnt erble vertrag"


def _documents(spark, sf):
    return table(spark, sf, "documents", spread=True).withColumnRenamed("doc_id", "id")


def _counted(units: str) -> str:
    """SQL: term counts, lengths and global numbers of `units(id, text)`."""
    return f"""WITH units AS ({units}),
 tok AS (SELECT id, unnest({words('text')}) AS term FROM units),
 tf AS (SELECT id, term, count(*) AS tf FROM tok GROUP BY ALL),
 dl AS (SELECT id, count(*) AS dl FROM tok GROUP BY ALL),
 st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
 df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL)"""


IDF = "ln(1 + (n - df + 0.5) / (df + 0.5))"
TF = "tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))"
DOCUMENTS = "SELECT doc_id AS id, text FROM documents"


def _asked(text: str) -> str:
    return f"(SELECT term, count(*) AS qtf FROM (SELECT unnest({words(text)}) AS term) GROUP BY ALL)"


def _scores(text: str) -> str:
    return (f"SELECT id, sum(qtf * {IDF} * {TF}) AS score FROM tf JOIN {_asked(text)} q USING (term)"
            " JOIN df USING (term) JOIN dl USING (id) CROSS JOIN st GROUP BY id")


@query("bm25_search", f"""{_counted(DOCUMENTS)}, s AS ({_scores(f"'{WANTED}'")})
 SELECT id, round(score, 6) AS score FROM s ORDER BY round(score, 6) DESC, id LIMIT 100""")
def bm25_search(spark, sf):
    hits = relevance.bm25_search(_documents(spark, sf), "text", WANTED, mapping=TEXT_MAPPING)
    hits = hits.select("id", F.round("score", 6).alias("score"))
    return take_page(hits, Page(limit=100))


@query("bm25_filtered", f"""{_counted(DOCUMENTS)}, s AS ({_scores(f"'{WANTED}'")})
 SELECT id, lang, round(score, 6) AS score FROM s JOIN documents ON doc_id = id
 WHERE lang = 'de' AND n_chars >= 500""")
def bm25_filtered(spark, sf):
    """All hits of a filtered search; the term statistics remain those of the whole table."""
    hits = relevance.bm25_search(_documents(spark, sf), "text", WANTED, mapping=TEXT_MAPPING,
                                 where=Q.term("lang", "de") & Q.range("n_chars", 500, "*"))
    return hits.select("id", "lang", F.round("score", 6).alias("score"))


@query("boosted_search", f"""{_counted(DOCUMENTS)},
 a AS ({_scores("'thnt erble'")}), b AS ({_scores("'vertrag the'")})
 SELECT id, round(coalesce(3 * a.score, 0) + coalesce(0.5 * b.score, 0), 6) AS score
 FROM a FULL JOIN b USING (id)""")
def boosted_search(spark, sf):
    clauses = [relevance.Clause("text", "thnt erble", 3.0), relevance.Clause("text", "vertrag the", 0.5)]
    hits = relevance.search(_documents(spark, sf), clauses, mapping=TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("query_scored_bool", f"""{_counted(DOCUMENTS)}, s AS ({_scores("'thnt erble'")})
 SELECT id, round(s.score + CASE WHEN lang = 'en' THEN 1 ELSE 0 END, 6) AS score
 FROM s JOIN documents ON doc_id = id WHERE n_chars >= 500 AND source <> 'src0'""")
def query_scored_bool(spark, sf):
    """`must` scores, `should` adds to it, `filter` and `must_not` only choose."""
    tree = Q.bool(must=[Q.match("text", "thnt erble")], should=[Q.term("lang", "en")],
                  filter=[Q.range("n_chars", 500, "*")], must_not=[Q.term("source", "src0")])
    hits = relevance.score_query(_documents(spark, sf), tree, mapping=TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("query_scored_boost", f"""{_counted(DOCUMENTS)}, a AS ({_scores("'thnt'")}), b AS ({_scores("'vertrag und'")})
 SELECT id, round(score, 6) AS score FROM (SELECT doc_id AS id,
  coalesce(3 * a.score, 0) + coalesce(0.5 * b.score, 0) + CASE WHEN starts_with(lang, 'e') THEN 2 ELSE 0 END AS score
  FROM documents LEFT JOIN a ON a.id = doc_id LEFT JOIN b ON b.id = doc_id)
 WHERE score > 0 ORDER BY round(score, 6) DESC, id LIMIT 300""")
def query_scored_boost(spark, sf):
    """Boosts multiply, and a page without a sort follows the score."""
    tree = Q.bool(should=[Q.boost(Q.match("text", "thnt"), 3.0), Q.boost(Q.match("text", "vertrag und"), 0.5),
                          Q.boost(Q.prefix("lang", "e"), 2.0)])
    hits = relevance.score_query(_documents(spark, sf), tree, mapping=TEXT_MAPPING)
    return take_page(hits.select("id", F.round("score", 6).alias("score")), Page(limit=300))


LINES = """SELECT doc_id * 100000 + i AS id, line AS text FROM (
 SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"""


@query("nested_score_avg", f"""{_counted(LINES)}, s AS ({_scores("'the thnt erble'")})
 SELECT id // 100000 AS id, round(avg(score), 6) AS score FROM s GROUP BY ALL""")
def nested_score_avg(spark, sf):
    docs = _documents(spark, sf).select("id", F.transform(
        F.split("text", "\n"), lambda line: F.struct(line.alias("text"))).alias("nstd"))
    hits = relevance.search_nested(docs, "nstd", "text", "the thnt erble", mapping=TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("query_scored_nested", f"""{_counted(LINES)}, s AS ({_scores("'the thnt erble'")})
 SELECT id // 100000 AS id, round(2 * avg(score) + CASE WHEN any_value(lang) = 'en' THEN 1 ELSE 0 END, 6) AS score
 FROM s JOIN documents ON doc_id = id // 100000 GROUP BY ALL""")
def query_scored_nested(spark, sf):
    docs = _documents(spark, sf).select("id", "lang", F.transform(
        F.split("text", "\n"), lambda line: F.struct(line.alias("text"))).alias("nstd"))
    tree = Q.bool(must=[Q.boost(Q.nested(Q.match("text", "the thnt erble")), 2.0)], should=[Q.term("lang", "en")])
    hits = relevance.score_query(docs, tree, mapping=TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


def _picked(text: str, most: int | None = None) -> str:
    """SQL: the selected terms of one text."""
    limit = "" if most is None else f" LIMIT {most}"
    return f"""picked AS (SELECT term, df FROM {_asked(text)} q JOIN df USING (term) CROSS JOIN st
  ORDER BY round(qtf * (ln((n + 1.0) / (df + 1.0)) + 1.0), 9) DESC, term{limit}),
 need AS (SELECT greatest(1, CAST(floor(count(*) * 70 / 100) AS INT)) AS need FROM picked),
 alike AS (SELECT id, sum({IDF} * {TF}) AS score FROM tf JOIN picked USING (term)
  JOIN dl USING (id) CROSS JOIN st GROUP BY id
  HAVING count(*) >= (SELECT need FROM need))"""


LIKE = "(SELECT text FROM benchmark WHERE item_id = 1)"


@query("find_similar", f"""{_counted(DOCUMENTS)}, {_picked(LIKE)}
 SELECT id, round(score, 6) AS score FROM alike WHERE id <> 4""")
def find_similar(spark, sf):
    like = table(spark, sf, "benchmark").filter("item_id = 1").select("text").scalar()
    hits = relevance.find_similar(_documents(spark, sf), None, "4", ["text"], like, TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("find_similar_some", f"""{_counted(DOCUMENTS)}, {_picked(LIKE, 25)}
 SELECT id, round(score, 6) AS score FROM alike""")
def find_similar_some(spark, sf):
    """Only the 25 most telling words of the text are selected."""
    like = table(spark, sf, "benchmark").filter("item_id = 1").select("text").scalar()
    hits = relevance.find_similar(_documents(spark, sf), None, None, ["text"], like, TEXT_MAPPING, max_terms=25)
    return hits.select("id", F.round("score", 6).alias("score"))


def _two_fields(first: str, second: str, like: str) -> str:
    """SQL: similarity over two text fields (id, a, b) of a table; each field selects its own words."""
    def one(name: str, col: str) -> str:
        part = (_counted(f"SELECT id, {col} AS text FROM pairs_of_text") + f""",
 picked AS (SELECT term, df FROM {_asked(like)} q JOIN df USING (term)),
 alike AS (SELECT id, count(*) AS m, sum({IDF} * {TF}) AS score FROM tf JOIN picked USING (term)
  JOIN dl USING (id) CROSS JOIN st GROUP BY id)
 SELECT id, m, score, (SELECT count(*) FROM picked) AS n FROM alike""")
        return f"{name} AS ({part})"
    return f"""WITH pairs_of_text AS (SELECT conv_id * 1000 + turn AS id, {first} AS a, {second} AS b
  FROM conversations), {one('fa', 'a')}, {one('fb', 'b')}
 SELECT id, round(coalesce(fa.score, 0) + coalesce(fb.score, 0), 6) AS score FROM fa FULL JOIN fb USING (id)
 WHERE coalesce(fa.m, 0) + coalesce(fb.m, 0) >= greatest(1, CAST(floor(
  ((SELECT coalesce(max(n), 0) FROM fa) + (SELECT coalesce(max(n), 0) FROM fb)) * 70 / 100) AS INT))"""


REVERSED = "reverse(text)"
ONE_TURN = "(SELECT text || ' ' || reverse(text) FROM conversations WHERE conv_id = 0 AND turn = 0)"


def _talk(spark, sf):
    talk = table(spark, sf, "conversations", spread=True)
    docs = talk.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("said"),
                       F.reverse("text").alias("mirrored"))
    first = talk.filter("conv_id = 0 AND turn = 0")
    return docs, first.select(F.concat_ws(" ", "text", F.reverse("text"))).scalar()


@query("find_similar_two_fields", _two_fields("text", REVERSED, ONE_TURN))
def find_similar_two_fields(spark, sf):
    docs, like = _talk(spark, sf)
    hits = relevance.find_similar(docs, None, None, ["said", "mirrored"], like, TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


@query("find_similar_any_field", _two_fields("text", REVERSED, ONE_TURN))
def find_similar_any_field(spark, sf):
    """No field is named, so all text fields are searched."""
    docs, like = _talk(spark, sf)
    hits = relevance.find_similar(docs, None, None, None, like, TEXT_MAPPING)
    return hits.select("id", F.round("score", 6).alias("score"))


TURNS = "SELECT conv_id * 1000 + turn AS id, text FROM conversations"
ROLES = "SELECT conv_id * 1000 + turn AS id, role AS text FROM conversations"
SAID = "(SELECT text FROM conversations WHERE conv_id = 0 AND turn = 0)"


@query("find_similar_nested", f"""{_counted(
 f"SELECT id * 2 AS id, text FROM ({TURNS}) UNION ALL SELECT id * 2 + 1, text FROM ({ROLES})")},
 {_picked(SAID)}
 SELECT id // 2 AS id, round(score, 6) AS score FROM alike WHERE id % 2 = 0""")
def find_similar_nested(spark, sf):
    talk = table(spark, sf, "conversations", spread=True)
    docs = normalize(talk.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("a").alias("appid"),
        F.to_json(F.struct("role", "text")).alias("properties")))
    like = talk.filter("conv_id = 0 AND turn = 0").select("text").scalar()
    hits = relevance.find_similar(docs, None, None, ["properties.text"], like)
    return hits.select("id", F.round("score", 6).alias("score"))


def stored_index(spark, sf):
    """The term index of all documents, written once to the shared folder and read by every step."""
    docs = table(spark, sf, "documents", spread=True)
    return materialize(relevance.term_index(docs, "doc_id", "text"), "terms")


PROBES = f"""asked AS (SELECT query_id, term, count(*) AS qtf FROM (
  SELECT item_id AS query_id, unnest({words('text')}) AS term FROM benchmark) GROUP BY ALL)"""
RANK = "row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id)"


BM25_BATCH = f"""{_counted(DOCUMENTS)}, {PROBES},
 s AS (SELECT query_id, id, sum(qtf * {IDF} * {TF}) AS score FROM tf JOIN asked USING (term)
  JOIN df USING (term) JOIN dl USING (id) CROSS JOIN st GROUP BY ALL)
 SELECT query_id, id AS doc_id, round(score, 6) AS score, CAST({RANK} AS INT) AS rank FROM s
 QUALIFY rank <= 10"""


@query("bm25_batch", BM25_BATCH)
def bm25_batch(spark, sf):
    return relevance.bm25_batch(stored_index(spark, sf), table(spark, sf, "benchmark"),
                                "item_id", "text", k=10)


SIMILAR_BATCH = f"""{_counted(DOCUMENTS)}, {PROBES},
 picked AS (SELECT query_id, term, df FROM asked JOIN df USING (term)),
 need AS (SELECT query_id, greatest(1, CAST(floor(count(*) * 70 / 100) AS INT)) AS need
  FROM picked GROUP BY ALL),
 s AS (SELECT query_id, id, count(*) AS m, sum({IDF} * {TF}) AS score FROM tf
  JOIN picked USING (term) JOIN dl USING (id) CROSS JOIN st GROUP BY ALL)
 SELECT query_id, id AS doc_id, round(score, 6) AS score, CAST({RANK} AS INT) AS rank
 FROM s JOIN need USING (query_id) WHERE m >= need QUALIFY rank <= 10"""


@query("find_similar_batch", SIMILAR_BATCH)
def find_similar_batch(spark, sf):
    return relevance.find_similar_batch(stored_index(spark, sf), table(spark, sf, "benchmark"),
                                        "item_id", "text", k=10)


def stored_postings(spark, sf):
    docs = table(spark, sf, "documents", spread=True)
    return postings.store_postings(docs, "doc_id", "text", scratch_path(spark, "postings"))


@query("bm25_stored", BM25_BATCH)
def bm25_stored(spark, sf):
    """The same answer from an index that is stored by term, without the blocks that can't matter."""
    return postings.bm25_batch(stored_postings(spark, sf), table(spark, sf, "benchmark"), "item_id", "text", k=10)


@query("find_similar_stored", SIMILAR_BATCH)
def find_similar_stored(spark, sf):
    return postings.find_similar_batch(stored_postings(spark, sf), table(spark, sf, "benchmark"), "item_id", "text", k=10)


def _holding(test: str) -> str:
    """SQL: documents with a word `t` that passes a test."""
    return f"SELECT doc_id AS id FROM documents WHERE len(list_filter({words('text')}, lambda t: {test})) > 0"


@query("query_wildcard_leading", _holding("t LIKE '%ungen'"))
def query_wildcard_leading(spark, sf):
    """A pattern without a head, matched against the distinct words of the stored index."""
    return stored_postings(spark, sf).with_wildcard("*ungen").select(F.col("doc_id").alias("id"))


@query("query_fuzzy_stored", _holding("damerau_levenshtein(t, 'vertrga') <= 2"))
def query_fuzzy_stored(spark, sf):
    return stored_postings(spark, sf).with_typos("vertrga").select(F.col("doc_id").alias("id"))

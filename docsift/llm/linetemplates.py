"""Line deduplication with a tree of line templates; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import materialize
from docsift.plans.skew import BROADCAST_BYTES, salted_join
from docsift.session import stored_bytes

# Leading tokens that lead from the root to a leaf, after the number of tokens.
DEPTH = 3
# A template recurs when it occurs in so many different texts.
MIN_TEXTS = 10
# Lines of fewer tokens are never dropped.
MIN_TOKENS = 3
# At most one in so many tokens below the leading ones may be a variable field.
VARIABLE = 3
# A place varies where so many values or more stand between the same two neighbours; those that less than half of
# such lines hold are variable fields.
VALUES = 3
FIELD = "<*>"


def _tokens(line: Column) -> Column:
    """Words of a line; those with a digit are variable fields."""
    words = F.filter(F.split(line, r"[ \t\r\x0B\f]+"), lambda w: w != "")
    return F.when(line.rlike("[0-9]"),
                  F.transform(words, lambda w: F.when(w.rlike("[0-9]"), FIELD).otherwise(w))).otherwise(words)


def _lines(docs: DataFrame) -> DataFrame:
    """(id, th, pos, leaf, tokens) of each line with enough tokens. A leaf is the number of
    tokens and the first of them."""
    lines = docs.select("id", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    tokens = lines.select("id", "th", "pos", F.explode(F.array(_tokens(F.col("line")))).alias("tokens"))
    return tokens.filter(F.size("tokens") >= MIN_TOKENS).select(
        "id", "th", "pos", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"), "tokens")


def _told(table: DataFrame) -> DataFrame:
    """A stored table, told to all tasks if its files are small: then no task gets a whole hot key."""
    return F.broadcast(table) if stored_bytes(table) <= BROADCAST_BYTES else table


def line_templates(docs: DataFrame, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(id, th, pos, template) of each line in a leaf that holds lines of at least `min_texts` texts.

    Below the leading tokens, fields are told by diversity: a token is a variable field if at its place, between the
    same two neighbours, the lines of the leaf hold at least `VALUES` different tokens and this one less than half of
    them; or if it stands at its place in fewer than `min_texts` lines of the leaf. This holds however often a value occurs.
    A line with more fields than a third of its places is its own template.
    """
    lines = _lines(docs)
    leaves = (lines.select("leaf", "th").distinct().groupBy("leaf").agg(F.count("*").alias("texts"))
              .filter(F.col("texts") >= min_texts).select("leaf"))
    held = materialize(lines.join(_told(materialize(leaves, "leaves")), "leaf"), "lines")
    after = F.coalesce(F.get("tokens", F.col("i") + 1), F.lit(""))
    words = (held.select("id", "th", "pos", "leaf", "tokens", F.posexplode("tokens").alias("i", "token"))
             .filter(F.col("i") >= DEPTH)
             .select("id", "th", "pos", "i", F.xxhash64("leaf", "i", "token").alias("value"),
                     F.xxhash64("leaf", "i", F.get("tokens", F.col("i") - 1), after).alias("between")))
    counts = materialize(words.groupBy("value", "between").agg(F.count("*").alias("n")), "counts")
    rare = counts.groupBy("value").agg(F.sum("n").alias("of_value")).filter(F.col("of_value") < min_texts)
    varied = (counts.groupBy("between").agg(F.sum("n").alias("lines"), F.count("*").alias("values"))
              .filter(F.col("values") >= VALUES))
    told = (counts.join(rare, "value", "left").join(varied, "between", "left")
            .filter(F.col("of_value").isNotNull() | (F.col("n") * 2 < F.col("lines"))))
    told = materialize(told.select("value", "between", "n"), "fields")
    keys = ["value", "between"]
    met = salted_join(words, told.select(*keys), keys, "th", "value", right_unique=True,
                      counts=told.select(*keys, F.col("n").alias("_left"), F.lit(1).alias("_right")))
    fields = met.groupBy("id", "th", "pos").agg(F.collect_set("i").alias("fields"))
    # null ids meet null ids
    one, two = held.alias("one"), fields.alias("two")
    found = one.join(two, F.col("one.id").eqNullSafe(F.col("two.id")) & (F.col("one.th") == F.col("two.th"))
                     & (F.col("one.pos") == F.col("two.pos")), "left").select("one.*", "two.fields")
    few = F.col("fields").isNotNull() & (F.size("fields") * VARIABLE <= F.size("tokens") - DEPTH)
    general = F.transform("tokens", lambda t, i: F.when(F.array_contains("fields", i), FIELD).otherwise(t))
    return found.select("id", "th", "pos", F.xxhash64(
        F.size("tokens"), F.array_join(F.when(few, general).otherwise(F.col("tokens")), " ")).alias("template"))


def drop_recurring(docs: DataFrame, min_texts: int = MIN_TEXTS, id_col: str = "doc_id",
                   text_col: str = "text", counts: bool = False) -> DataFrame:
    """All rows and columns of `docs`, the text without the lines of recurring templates.

    A template recurs when it stands in at least `min_texts` different texts (copies of a whole document
    count once). It stays in the document with the smallest id among those that have it, and is dropped
    everywhere else. `counts` adds `n_lines` and `n_dropped`.

    Null text stays null (no lines); a text that loses all lines is empty. Blank and very short lines stay.
    Null ids come after all others: such a row keeps a template only if no row with an id has it. Rows with
    the same id and text are treated alike. Columns of any name are carried along.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                      F.xxhash64(F.col(f"`{text_col}`")).alias("th"))
    templates = materialize(line_templates(row.select("id", "th", "text"), min_texts), "templates")
    recurring = (templates.groupBy("template", "th").agg(F.min("id").alias("first"))
                 .groupBy("template").agg(F.count("*").alias("texts"), F.min("first").alias("first"))
                 .filter(F.col("texts") >= min_texts).select("template", "first"))
    drops = (templates.join(_told(materialize(recurring, "recurring")), "template").filter(~F.col("id").eqNullSafe(F.col("first")))
             .groupBy("id", "th").agg(F.collect_set("pos").alias("drops")))
    one, two = row.alias("one"), materialize(drops, "drops").alias("two")
    found = one.join(two, (F.col("one.th") == F.col("two.th")) & F.col("one.id").eqNullSafe(F.col("two.id")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("drops", i)), "\n")
    text = F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept)
    out = found.select("row", F.col("one.text").alias("text"), "two.drops")
    more = [F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
            F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped")]
    return out.select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns],
                      *more * counts)


# What `recurring` keeps, as SQL over a table documents(doc_id, text).
def kept_sql(source: str = "documents", min_texts: int = MIN_TEXTS) -> str:
    """SQL for (doc_id, text, kept, n_lines, n_dropped) of each row of `source`."""
    return rf"""
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, text FROM {source}),
split_ AS (SELECT r, doc_id, text, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM rows_ WHERE text IS NOT NULL),
lines_ AS (SELECT r, doc_id, text, pos, list_transform(
   list_filter(string_split_regex(line, '[ \t\r\x0B\f]+'), lambda w: w <> ''),
   lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '{FIELD}' ELSE w END) AS tokens FROM split_),
leafed AS (SELECT *, len(tokens) AS n, tokens[1:{DEPTH}] AS head FROM lines_ WHERE len(tokens) >= {MIN_TOKENS}),
leaves AS (SELECT n, head FROM leafed GROUP BY ALL HAVING count(DISTINCT text) >= {min_texts}),
held AS (SELECT l.* FROM leafed l JOIN leaves USING (n, head)),
words_ AS (SELECT r, pos, n, head, unnest(tokens) AS token, unnest(list_concat([''], tokens[:-2])) AS before_,
  unnest(list_concat(tokens[2:], [''])) AS after_, generate_subscripts(tokens, 1) AS i FROM held),
counts_ AS (SELECT n, head, i, before_, after_, token, count(*) AS c FROM words_ WHERE i > {DEPTH} GROUP BY ALL),
told AS (SELECT *, sum(c) OVER (PARTITION BY n, head, i, token) AS of_value,
  sum(c) OVER (PARTITION BY n, head, i, before_, after_) AS lines_held,
  count(*) OVER (PARTITION BY n, head, i, before_, after_) AS values_ FROM counts_),
fields_ AS (SELECT * FROM told WHERE of_value < {min_texts} OR (values_ >= {VALUES} AND c * 2 < lines_held)),
marked AS (SELECT w.*, f.c IS NOT NULL AS field
  FROM words_ w LEFT JOIN fields_ f USING (n, head, i, before_, after_, token)),
templates AS (SELECT r, pos, CASE WHEN count(*) FILTER (WHERE field) * {VARIABLE} <= any_value(n) - {DEPTH}
   THEN string_agg(CASE WHEN field THEN '{FIELD}' ELSE token END, ' ' ORDER BY i)
   ELSE string_agg(token, ' ' ORDER BY i) END AS template FROM marked GROUP BY r, pos),
recurring AS (SELECT template, min(doc_id) AS first_ FROM templates JOIN rows_ USING (r)
  GROUP BY template HAVING count(DISTINCT text) >= {min_texts}),
drops AS (SELECT r, pos FROM templates JOIN rows_ USING (r) JOIN recurring USING (template)
  WHERE doc_id IS DISTINCT FROM first_)
SELECT doc_id, text, kept, n_lines, n_dropped FROM (
 SELECT r, any_value(doc_id) AS doc_id, any_value(text) AS text,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '') AS kept,
  count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped
 FROM (SELECT s.*, d.pos IS NOT NULL AS dropped FROM split_ s LEFT JOIN drops d USING (r, pos)) GROUP BY r
 UNION ALL SELECT r, doc_id, text, text, 0, 0 FROM rows_ WHERE text IS NULL)"""

"""Ranked search and similarity.

A single query needs two narrow passes over the documents: one that counts its few terms, and one that
scores each document inside its own row. A table of queries works on a term index (one row per
document with its term counts) and joins on the terms that can still decide the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions import keys
from docsift.functions.text import count_of, let, term_counts, tokens
from docsift.operators.find import nothing, scope
from docsift.plans.once import with_once
from docsift.plans.predicates import Bool, Boost, Fields, Match, Nested, Query, Text, condition
from docsift.plans.skew import salted_join
from docsift.schema import DEFAULT_MAPPING, PROPS, FieldMapping
from docsift.session import materialize

# Fixed values of the ranking function.
K1 = 1.2
B = 0.75
# Fixed value of the similarity query: share of the selected terms that must occur.
MATCH_PERCENT = 70
# Up to this k Spark keeps the best k of each task before a shuffle by itself.
GROUP_LIMIT = 1000


# ---------------------------------------------------------------- formulas

def _idf(n: Column, df: Column) -> Column:
    return F.log1p((n - df + 0.5) / (df + 0.5))


def _tf_part(tf: Column, length: Column, avg: Column) -> Column:
    return tf / (tf + (F.lit(1 - B) + F.lit(B) * length / avg) * K1)


def _required(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n * MATCH_PERCENT / 100).cast("int"))


def _pick_weight(tf: Column, n: Column, df: Column) -> Column:
    """What ranks the words of a given text; rounded so that ties are decided by the word."""
    return F.round(tf * (F.log((n + 1.0) / (df + 1.0)) + 1.0), 9)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


# ---------------------------------------------------------------- one query

def term_words(docs: DataFrame, field: str, mapping: FieldMapping) -> Column:
    """Analysed words of a field; an array column counts as already analysed."""
    fields = Fields(docs.schema, mapping)
    col = fields.column(field)
    return col if isinstance(fields.type_of(field), T.ArrayType) else tokens(col)


def _term_stats(units: DataFrame, wanted: Column, unit: str = "words") -> DataFrame:
    """One row `(n, avg, df)` about all units: how many there are, their mean length, and a map
    from each wanted term to the number of units that have it.

    Each unit sends an empty mark for itself and one row per wanted term it has; a task
    reduces those to at most one row per wanted term before anything is shuffled. Units without words
    are left out when counting, since a filter on them would analyse the text a second time.
    """
    marks = units.select(
        F.size(unit).alias("length"),
        F.explode(F.array_union(F.array(F.lit("")), F.array_intersect(wanted, F.col(unit))))
        .alias("term"))
    counts = marks.groupBy("term").agg(F.count_if(F.col("length") > 0).alias("units"),
                                       F.sum("length").alias("length"))
    own = F.col("term") == ""
    return counts.agg(
        F.coalesce(F.max(F.when(own, F.col("units"))), F.lit(0)).alias("n"),
        F.max(F.when(own & (F.col("units") > 0), F.col("length") / F.col("units"))).alias("avg"),
        F.map_from_entries(F.collect_list(
            F.when(~own, F.struct("term", "units")))).alias("df"))


def _asked(docs: DataFrame, text: str | Column) -> Column:
    """Words of a query: a constant, or a one-value subquery that is analysed once and not per row."""
    if isinstance(text, str):
        return tokens(F.lit(text))
    return docs.sparkSession.range(1).select(tokens(text)).scalar()


def _weighted(stats: DataFrame, *asked: Column) -> DataFrame:
    """The one-row statistics with the terms and weights of each text in place of the counts: `avg`, `terms`,
    `terms1`, ..."""
    def terms(words: Column) -> Column:
        weights = F.transform(term_counts(words), lambda q: F.struct(
            q["term"].alias("term"),
            (q["tf"] * _idf(F.col("n"), F.element_at(F.col("df"), q["term"]))).alias("w")))
        return F.filter(weights, lambda q: q["w"].isNotNull())

    given = {f"_asked{i}": words for i, words in enumerate(asked)}
    return stats.withColumns(given).select(
        "avg", *[terms(F.col(name)).alias(f"terms{i or ''}") for i, name in enumerate(given)])


def _field_stats(count: Callable[[Column], DataFrame], asked: Sequence[Column]) -> Column:
    """What the texts asked of one field need, from one count of all their words."""
    none = F.array().cast("array<string>")
    wanted = reduce(F.array_union, [F.coalesce(words, none) for words in asked])
    return _subquery(_weighted(count(wanted), *asked))


def _score(words: Column, stats: Column, boost: float = 1.0, terms: str = "terms") -> Column:
    """Score of one token array; 0 when no term occurs. `stats` is a one-row subquery, `terms` says which of its texts."""
    length = F.size(words).cast("double")

    def part(q: Column) -> Column:
        return let(count_of(words, q["term"]).cast("double"),
                   lambda tf: q["w"] * _tf_part(tf, length, stats["avg"]))

    total = F.coalesce(_sum(F.transform(stats[terms], part)), F.lit(0.0))
    return total if boost == 1.0 else total * boost


def _subquery(one_row: DataFrame) -> Column:
    return one_row.select(F.struct(*one_row.columns).alias("stats")).scalar()


@dataclass(frozen=True)
class Clause:
    """One scoring clause: words wanted in a field, and the factor on their score."""

    field: str
    text: str | Column
    boost: float = 1.0


def search(docs: DataFrame, clauses: Sequence[Clause], type: str | None = None,
           where: Query | None = None, mapping: FieldMapping = DEFAULT_MAPPING,
           statistics: Callable[[str, Column], DataFrame] | None = None) -> DataFrame:
    """Documents that match any clause, with `score`: the boosted sum of the clause scores.

    Term statistics are those of all of `docs`; `type` and `where` only choose among the hits. An index that keeps
    them (`BucketedIndex.term_statistics`) saves the pass that counts them.
    """
    names = sorted({c.field for c in clauses})
    column_of = {name: f"_w{i}" for i, name in enumerate(names)}
    words = {col: term_words(docs, name, mapping) for name, col in column_of.items()}
    asked: dict[str, list[Column]] = {col: [] for col in words}
    parts = []
    for clause in clauses:
        col = column_of[clause.field]
        terms = f"terms{len(asked[col]) or ''}"
        asked[col].append(_asked(docs, clause.text))
        parts.append(F.when(F.size(col) > 0, _score(F.col(col), F.col(f"_q{col}"), clause.boost, terms))
                     .otherwise(0.0))
    field_of = {col: name for name, col in column_of.items()}

    def counted(col: str) -> Callable[[Column], DataFrame]:
        if statistics is not None:
            return partial(statistics, field_of[col])
        return partial(_term_stats, docs.select(words[col].alias("words")))

    stats = {f"_q{col}": _field_stats(counted(col), texts) for col, texts in asked.items()}
    hits = scope(docs, type=type)
    if where is not None:
        hits = hits.filter(condition(hits, where, mapping))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    for col, value in words.items():
        hits = with_once(hits, col, value)
    return (with_once(hits.withColumns(stats), "score", total)
            .filter(F.col("score") > 0).drop(*words, *stats))


def bm25_search(docs: DataFrame, field: str, query: str | Column, type: str | None = None,
                where: Query | None = None, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    return search(docs, [Clause(field, query)], type, where, mapping)


def search_nested(docs: DataFrame, path: str, field: str, query: str | Column,
                  type: str | None = None, mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """Scored search inside an array of objects: each object is scored on its own, and a document
    gets the mean score of its matching objects."""
    inner = docs.schema[path].dataType.elementType
    fields = Fields(inner, mapping)
    typed = isinstance(fields.type_of(field), T.ArrayType)

    def words_of(o: Column) -> Column:
        value = Fields(inner, mapping, o).column(field)
        return value if typed else tokens(value)

    asked = _asked(docs, query)
    elements = F.transform(F.col(path), words_of)
    units = docs.select(F.explode(elements).alias("words"))
    stats = _field_stats(partial(_term_stats, units), [asked])
    scores = F.filter(F.transform(F.col("_words"), lambda w: F.when(
        F.size(w) > 0, _score(w, F.col("_q"))).otherwise(0.0)), lambda s: s > 0)
    rows = with_once(scope(docs, type=type), "_words", elements).withColumn("_q", stats)
    return (with_once(rows, "_scores", scores)
            .filter(F.size("_scores") > 0)
            .withColumn("score", _sum(F.col("_scores")) / F.size("_scores"))
            .drop("_words", "_scores", "_q"))


# ---------------------------------------------------------------- scored trees

class _Tree:
    """Collects what the scored leaves of a predicate tree need: words per field, statistics per leaf."""

    def __init__(self, docs: DataFrame, mapping: FieldMapping):
        self.docs, self.mapping = docs, mapping
        self.fields = Fields(docs.schema, mapping)
        self.words: dict[str, str] = {}
        self.asked: dict[str, list[Column]] = {}
        self.objects: dict[str, Column] = {}

    def _matched(self, field: str, value: str) -> Column:
        """BM25 of a text field; statistics are those of all documents."""
        words = self.words.setdefault(field, f"_w{len(self.words)}")
        asked = self.asked.setdefault(field, [])
        terms = f"terms{len(asked) or ''}"
        asked.append(tokens(F.lit(value)))
        return F.when(F.size(words) > 0, _score(F.col(words), F.col(f"_q{words}"), terms=terms)).otherwise(0.0)

    def stats(self) -> dict[str, Column]:
        """The statistics that the leaves collected so far need: one pass over the words of each field."""
        return self.objects | {f"_q{self.words[field]}": _field_stats(
            partial(_term_stats, self.docs.select(term_words(self.docs, field, self.mapping).alias("words"))), asked)
            for field, asked in self.asked.items()}

    def _objects(self, query: Nested) -> Column:
        """Mean score of the objects that match: BM25 for a text in one field, else 1 each."""
        kind = self.fields.type_of(query.path).elementType
        inner = query.query
        objects = F.filter(F.col(query.path), lambda o: F.coalesce(
            inner.compile(Fields(kind, self.mapping, o)), F.lit(False)))
        if not isinstance(inner, Match) or not Fields(kind, self.mapping).is_text(inner.field):
            return F.when(F.size(objects) > 0, 1.0).otherwise(0.0)

        def words_of(o: Column) -> Column:
            return tokens(Fields(kind, self.mapping, o).column(inner.field))

        name, asked = f"_q{len(self.objects)}", tokens(F.lit(inner.value))
        units = self.docs.select(F.explode(F.transform(query.path, words_of)).alias("words"))
        self.objects[name] = _field_stats(partial(_term_stats, units), [asked])
        # words are used once per term of the query
        scores = F.transform(objects, lambda o: let(words_of(o), lambda w: _score(w, F.col(name))))
        return let(scores, lambda s: F.when(F.size(s) > 0, _sum(s) / F.size(s)).otherwise(0.0))

    def score(self, query: Query, matches: bool = False) -> Column:
        """The score that a document gets from `query`; 0 where it does not match. `matches` says that only documents that
        match are asked for, so that the tree is not tested again."""
        if isinstance(query, Boost):
            return self.score(query.query, matches) * query.factor
        if isinstance(query, Bool):
            parts = [*[self.score(q, matches) for q in query.must], *[self.score(q) for q in query.should]]
            total = reduce(lambda a, b: a + b, parts, F.lit(0.0))
            return total if matches else F.when(F.coalesce(query.compile(self.fields), F.lit(False)), total).otherwise(0.0)
        if isinstance(query, Nested):
            return self._objects(query)
        if isinstance(query, Match) and not self.fields.is_pair(query.field) and self.fields.is_text(query.field):
            return self._matched(query.field, query.value)
        if isinstance(query, Text):
            names = [f.name for f in self.fields.schema.fields if isinstance(f.dataType, T.StringType)
                     and self.fields.is_text(f.name) and not f.name.startswith("_")]
            plain = F.when(F.coalesce(query.compile(self.fields), F.lit(False)), 1.0).otherwise(0.0)
            best = [self._matched(name, query.value) for name in names]
            return F.when(plain > 0, F.greatest(F.lit(0.0), *best)).otherwise(0.0) if best else plain
        return F.when(F.coalesce(query.compile(self.fields), F.lit(False)), 1.0).otherwise(0.0)


def score_query(docs: DataFrame, query: Query, type: str | None = None,
                mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """The documents that match a predicate tree, with `score`.

    `must` and `should` clauses add up, `filter` and `must_not` count nothing, so a `should` beside a `must`
    changes the order only. A text field gives BM25 with the statistics of all documents, a text without a
    field its best field; nested objects give the mean of the matching ones; every other leaf gives 1 where
    it matches. Boosts multiply.
    """
    tree = _Tree(docs, mapping)
    total = tree.score(query, matches=True)
    hits = scope(docs, type=type).filter(condition(docs, query, mapping))
    for field, name in tree.words.items():
        hits = with_once(hits, name, term_words(docs, field, mapping))
    stats = tree.stats()
    return with_once(hits.withColumns(stats), "score", total).drop(*tree.words.values(), *stats)


# ---------------------------------------------------------------- similarity to one text

def _first(ranked: Column, max_terms: int | None) -> Column:
    return ranked if max_terms is None else F.slice(ranked, 1, max_terms)


def _selected(stats: DataFrame, like: Column, max_terms: int | None) -> DataFrame:
    """One row: mean length, the selected terms with their weights, and how many must occur."""
    n, df = F.col("n"), F.col("df")
    known = F.filter(term_counts(F.col("like")), lambda t: F.element_at(df, t["term"]).isNotNull())
    ranked = F.sort_array(F.transform(known, lambda t: F.struct(
        (-_pick_weight(t["tf"], n, F.element_at(df, t["term"]))).alias("r"),
        t["term"].alias("term"),
        _idf(n, F.element_at(df, t["term"])).alias("w"))))
    picked = _first(ranked, max_terms)
    return (stats.withColumn("like", like).select("avg", picked.alias("terms"))
            .withColumn("need", _required(F.size("terms"))))


def _present(words: Column, terms: Column) -> Column:
    return F.size(F.filter(terms, lambda t: F.array_contains(words, t["term"])))


def find_similar(docs: DataFrame, type: str | None, filter_key: str | None,
                 fields: Sequence[str] | None, like: str | Column | None,
                 mapping: FieldMapping = DEFAULT_MAPPING, max_terms: int | None = None) -> DataFrame:
    """Documents that have at least 70 % of the known words of `like`, scored by them.

    All words that occur in the documents are selected; `max_terms` takes only that many of the most telling,
    as servers do by default. Without fields all text columns are searched. Each plain field selects its own words, and the share
    is taken over all of them. For properties the words must meet in one pair whose key shares a word
    with the field name. `like` may be a one-value subquery.
    """
    if like is None or (isinstance(like, str) and not like.strip()):
        return nothing(docs).withColumn("score", F.lit(0.0))
    given = _asked(docs, like)
    schema = Fields(docs.schema, mapping)
    names = list(fields or [f.name for f in docs.schema.fields
                            if isinstance(f.dataType, T.StringType) and schema.is_text(f.name)
                            and not f.name.startswith("_")])
    hits = scope(docs, type=type)
    if filter_key is not None and filter_key.strip():
        hits = hits.filter(F.col("id") != filter_key)
    if any(schema.is_pair(n) for n in names):
        return _similar_pairs(docs, hits, [n for n in names if schema.is_pair(n)], given, max_terms)
    if not names:
        return nothing(docs).withColumn("score", F.lit(0.0))
    total, present, count = F.lit(0.0), F.lit(0), F.lit(0)
    for i, name in enumerate(names):
        words = term_words(docs, name, mapping)
        stats = _term_stats(docs.select(words.alias("words")), given)
        hits = (with_once(hits, f"_w{i}", F.coalesce(words, F.array().cast("array<string>")))
                .withColumn(f"_q{i}", _subquery(_selected(stats, given, max_terms))))
        own, chosen = F.col(f"_w{i}"), F.col(f"_q{i}")
        present, count = present + _present(own, chosen["terms"]), count + F.size(chosen["terms"])
        total = total + F.when(F.size(own) > 0, _score(own, chosen)).otherwise(0.0)
    used = [f"_{kind}{i}" for kind in "wq" for i in range(len(names))]
    return (hits.filter((count > 0) & (present >= _required(count)))
            .withColumn("score", total).drop(*used))


def _similar_pairs(docs: DataFrame, hits: DataFrame, names: Sequence[str],
                   given: Column, max_terms: int | None) -> DataFrame:
    docs, hits = (with_once(d, PROPS, F.col(PROPS)).select(*d.columns) for d in (docs, hits))
    typed = "kt" in docs.schema[PROPS].dataType.elementType.fieldNames()

    def value_words(p: Column) -> Column:
        return p["vt"] if typed else tokens(p["v"])

    units = docs.select(F.explode(PROPS).alias("p")).select(value_words(F.col("p")).alias("words"))
    stats = _subquery(_selected(_term_stats(units, given), given, max_terms))
    chosen = F.col("_q")

    def score(p: Column) -> Column:
        return let(value_words(p), lambda w: F.when(
            _present(w, chosen["terms"]) >= chosen["need"], _score(w, chosen)))

    total = F.lit(0.0)
    for name in names:
        key_words = tokens(F.lit(keys.nested_key(name)))
        pairs = F.filter(F.col(PROPS), lambda p: F.arrays_overlap(
            p["kt"] if typed else tokens(p["k"]), key_words))
        found = F.filter(F.transform(pairs, score), lambda s: s.isNotNull())
        total = total + let(found, lambda s: F.when(F.size(s) > 0, _sum(s) / F.size(s))
                            .otherwise(0.0))
    rows = hits.withColumn("_q", stats).filter(F.size(chosen["terms"]) > 0)
    return with_once(rows, "score", total).filter(F.col("score") > 0).drop("_q")


# ---------------------------------------------------------------- tables of queries

def term_index(docs: DataFrame, id: str, text: str,
               mapping: FieldMapping = DEFAULT_MAPPING) -> DataFrame:
    """One row per document that has words: `doc_id`, `length`, `terms` array<struct<term, tf>>.

    A narrow map of the documents; store it once and use it for any number of batches.
    """
    words = with_once(docs.select(F.col(id).alias("doc_id"), F.col(text)), "words",
                      term_words(docs, text, mapping))
    return (words.filter(F.size("words") > 0)
            .select("doc_id", F.size("words").alias("length"),
                    term_counts(F.col("words")).alias("terms")))


def _postings(index: DataFrame, *more: str) -> DataFrame:
    return index.select("doc_id", *more, F.inline("terms"))


@dataclass(frozen=True)
class _Batch:
    """A term index with its two global numbers, and the size from which a key is split."""

    index: DataFrame
    n: int
    avg: float
    hot_rows: int

    @staticmethod
    def of(index: DataFrame, hot_rows: int) -> "_Batch":
        row = index.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg")).first()
        return _Batch(index, row["n"], row["avg"] or 1.0, hot_rows)

    def query_terms(self, queries: DataFrame, id: str, text: str) -> DataFrame:
        """`(query_id, term, tf, df)` for the words of the queries that occur in the index.

        Document frequencies are counted before the join, with partial sums, so that a word
        found in every document arrives as a single row.
        """
        asked = queries.select(F.col(id).alias("query_id"),
                               F.inline(term_counts(tokens(F.col(text)))))
        df = _postings(self.index).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        return salted_join(asked, df, ["term"], "query_id", "term", self.hot_rows, right_unique=True)

    def part(self) -> Column:
        """Score of one matching term, from the columns of a posting and of the query."""
        return F.col("w") * _tf_part(F.col("tf").cast("double"), F.col("length").cast("double"),
                                     F.lit(self.avg))

    def met(self, wanted: DataFrame, *carry: str) -> DataFrame:
        """`(query_id, doc_id)` that share one of the `wanted` terms `(query_id, term, df, w)`, with
        `part`, the score of those terms alone, and the `carry` columns of the query."""
        counts = wanted.groupBy("term").agg(F.first("df").alias("_left"),
                                            F.count(F.lit(1)).alias("_right"))
        met = salted_join(_postings(self.index, "length"), wanted.drop("df"), ["term"],
                          "doc_id", "query_id", self.hot_rows, counts)
        return met.groupBy("query_id", "doc_id", *carry).agg(F.sum(self.part()).alias("part"))

    def matches(self, pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """`(query_id, doc_id, part)` for each of the `asked` terms that a pair has in common.

        Only the postings of documents that are in a pair take part; they meet the asked terms on
        (document, term), which spreads a document wanted by many queries over its terms.
        """
        met = self.index.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
        wanted = (salted_join(pairs.select("query_id", "doc_id"), asked.select("query_id", "asked"),
                              ["query_id"], "doc_id", "query_id", self.hot_rows, right_unique=True)
                  .select("query_id", "doc_id", F.inline("asked")))
        return (wanted.select("query_id", "doc_id", "term", "w")
                .join(_postings(met, "length"), ["doc_id", "term"])
                .select("query_id", "doc_id", self.part().alias("part")))

    def scored(self, pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """`pairs` with the number of matching terms and the score over all `asked` terms."""
        return self.matches(pairs, asked).groupBy("query_id", "doc_id").agg(
            F.count(F.lit(1)).alias("matched"), F.sum("part").alias("score"))


def _top(scored: DataFrame, k: int) -> DataFrame:
    """The best k per query. Each task keeps its own best k before the shuffle, so one query with a
    third of all pairs stays small. Spark leaves that out for a large k: the pairs of a query are then cut into
    parts of their own first, and the k best of each part meet."""
    scored = scored.withColumn("score", F.round("score", 6))
    if k > GROUP_LIMIT:
        parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        within = Window.partitionBy("query_id", "_part").orderBy(F.col("score").desc(), F.col("doc_id").asc())
        scored = (scored.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
                  .withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= k)
                  .drop("_part", "_rank"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def find_similar_batch(index: DataFrame, queries: DataFrame, id: str, text: str, k: int = 10,
                       exclude_same_id: bool = False, hot_rows: int = 1_000_000,
                       max_terms: int | None = None) -> DataFrame:
    """For each row of `queries` the k most similar documents: `query_id, doc_id, score, rank`.

    A document must have `need` of the n selected terms, so it has at least one of any n - need + 1
    of them. The join uses the n - need + 1 rarest; it finds every answer and leaves the common words
    out. The pairs found are then checked against all selected terms.
    """
    batch = _Batch.of(index, hot_rows)
    n, df = F.lit(batch.n), F.col("df")
    terms = batch.query_terms(queries, id, text).withColumn("r", -_pick_weight(F.col("tf"), n, df))
    # a query's own words, so the group is no larger than the text it came from
    picked = _first(F.sort_array(F.collect_list(
        F.struct("r", "term", "df", _idf(n, df).alias("w")))), max_terms)
    asked = materialize(terms.groupBy("query_id").agg(picked.alias("asked"))
                        .withColumn("need", _required(F.size("asked"))), "asked")
    rarest = F.slice(F.sort_array(F.transform("asked", lambda t: F.struct(
        t["df"], t["term"], t["w"]))), F.lit(1), F.size("asked") - F.col("need") + 1)
    pairs = batch.met(asked.select("query_id", F.inline(rarest))).drop("part")
    if exclude_same_id:
        pairs = pairs.filter(F.col("query_id") != F.col("doc_id"))
    pairs = materialize(pairs, "pairs")
    scored = (batch.scored(pairs, asked).join(asked.select("query_id", "need"), "query_id")
              .filter(F.col("matched") >= F.col("need")))
    return _top(scored, k).select("query_id", "doc_id", "score", "rank")


def bm25_batch(index: DataFrame, queries: DataFrame, id: str, text: str, k: int = 10,
               hot_rows: int = 1_000_000) -> DataFrame:
    """For each row of `queries` the k best documents: `query_id, doc_id, score, rank`.

    A document counts if it has any word of the query, but few of them can reach the top. First the
    documents met by the rarest words of each query, a few times k of them, are scored: their k-th
    score is a floor that the answer cannot fall below. A term adds less than its weight, so documents
    that have only the lightest terms, whose weights together stay below half the floor, cannot be in
    the answer: the second join leaves those terms out. Of what it meets, only documents whose partial
    score could still reach the floor are looked at for the light terms too. The result is exact.
    """
    batch = _Batch.of(index, hot_rows)
    terms = batch.query_terms(queries, id, text)
    weight = F.col("tf") * _idf(F.lit(batch.n), F.col("df"))
    asked = materialize(terms.groupBy("query_id").agg(F.sort_array(F.collect_list(
        F.struct("df", "term", weight.alias("w")))).alias("asked")), "asked")

    def running(values: Column, i: Column) -> Column:
        """Sum of the first i values."""
        return _sum(F.slice(values, F.lit(1), i))

    frequencies = F.transform("asked", lambda t: t["df"].cast("double"))
    first = F.filter("asked", lambda t, i: running(frequencies, i) < 4 * k)
    seeds = materialize(batch.met(asked.select("query_id", F.inline(first))).drop("part"), "seeds")
    floor = (_top(batch.scored(seeds, asked), k)
             .groupBy("query_id").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("low"))
             .select("query_id", F.when(F.col("found") >= k, F.col("low") - 1e-5).alias("low")))
    by_weight = F.sort_array(F.transform("asked", lambda t: F.struct(t["w"], t["term"], t["df"])))
    weights = F.transform("by_weight", lambda t: t["w"])
    # leaving out no more than half the floor makes the test on partial scores a sharp one
    light = F.filter("by_weight", lambda t, i: F.coalesce(
        running(weights, i + 1) < F.col("low") / 2, F.lit(False)))
    bounds = materialize(
        asked.join(floor, "query_id", "left").withColumn("by_weight", by_weight)
        .select("query_id", "low", "by_weight", light.alias("asked"))
        .withColumn("heavy", F.slice("by_weight", F.size("asked") + 1,
                                     F.size("by_weight"))).drop("by_weight")
        .withColumn("rest", _sum(F.transform("asked", lambda t: t["w"]))), "bounds")
    met = batch.met(bounds.select("query_id", "low", "rest", F.inline("heavy")), "low", "rest")
    able = met.filter(F.col("low").isNull() | (F.col("part") + F.col("rest") >= F.col("low")))
    pairs = materialize(able.select("query_id", "doc_id", "part"), "pairs")
    scored = (pairs.unionByName(batch.matches(pairs, bounds))
              .groupBy("query_id", "doc_id").agg(F.sum("part").alias("score")))
    return _top(scored, k).select("query_id", "doc_id", "score", "rank")

"""Toxicity: misspelled terms of a learned lexicon, weighed by their context."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import chunks, materialize, pick

# Labelled documents of each class that the lexicon and the weights are fitted on, by hash of their id.
SAMPLE = 10_000
# Most terms in a lexicon, the smallest log-likelihood ratio of a term (a chance of about 1 in 10^8), and how
# many times likelier it must be in a toxic document.
TERMS, EVIDENCE, RATIO = 3_000, 33.0, 8.0
# A term of so many letters may be misspelled by one edit or one swap of neighbours.
MISSPELLED = 5
# Lengths of stems: a lexicon may hold `stem*`, for all longer words that begin with it.
STEMS = (4, 5, 6)
# Words to either side of a term that count as its context.
WINDOW = 4
THRESHOLD = 0.7
# Distinct words whose matches a task remembers; a full memory is emptied.
MEMORY = 400_000

_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = "\"'“”„«»‘’‹›`"
FEATURES = 6


def stems_of(word: str) -> list[str]:
    return [word[:k] + "*" for k in STEMS if len(word) > k]


def terms_of(text: str) -> set[str]:
    """All words of a text and their stems."""
    words = set(_WORD.findall(text.lower()))
    return words.union(*map(stems_of, words))


class Automaton:
    """A trie of terms intersected with the Levenshtein automaton of one edit, determinised as it is used.

    A state is the set of places in the trie that the letters so far can stand at: (node, edits, letter that
    must follow to complete a swap). States and moves are kept, so a letter costs one look-up.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.stems = {t: i for i, t in enumerate(terms) if t.endswith("*")}
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]
        self.loose = [False]  # some term below may be misspelled
        for number, term in enumerate(terms):
            if term in self.stems:
                continue
            node = 0
            self.loose[0] |= len(term) >= MISSPELLED
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                    self.loose.append(False)
                node = self.children[node][letter]
                self.loose[node] |= len(term) >= MISSPELLED
            self.term[node] = number
        self.letters = {letter for c in self.children for letter in c}
        self.states: dict[frozenset, int] = {}
        self.places: list[frozenset] = []
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state({(0, 0, "")})
        self.known: dict[str, tuple[int, int] | None] = {}

    def _state(self, places: set) -> int:
        """Number of the state; a letter of the term may be left out at any place."""
        full = set(places)
        for node, edits, swap in places:
            if not edits and not swap:
                full |= {(child, 1, "") for child in self.children[node].values() if self.loose[child]}
        key = frozenset(p for p in full if p[1] == 0 or p[2] or (p[0], 0, "") not in full)
        if not key:
            return -1
        if key not in self.states:
            self.states[key] = len(self.places)
            self.places.append(key)
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        found = set()
        for node, edits, swap in self.places[state]:
            if swap:
                if swap == letter:
                    found.add((node, 1, ""))
                continue
            below = self.children[node]
            if letter in below:
                found.add((below[letter], edits, ""))
            if not edits and self.loose[node]:
                found.add((node, 1, ""))
                for first, child in below.items():
                    if self.loose[child]:
                        found.add((child, 1, ""))
                        if letter in self.children[child] and letter != first:
                            found.add((self.children[child][letter], 1, first))
        return self._state(found)

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the word's own term, its longest stem, or else the first term within one edit."""
        if word in self.known:
            return self.known[word]
        state = self.start
        for letter in word:
            key = state, letter if letter in self.letters else ""
            state = self.moves.get(key)
            if state is None:
                state = self.moves[key] = self._move(*key)
            if state < 0:
                break
        best = None
        if state >= 0:
            ends = [(edits, self.term[node]) for node, edits, swap in self.places[state]
                    if not swap and self.term[node] >= 0]
            ends = [(e, t) for e, t in ends if not e or len(self.terms[t]) >= MISSPELLED]
            best = min(ends)[::-1] if ends else None
        if best is None or best[1]:
            stems = [self.stems[s] for s in stems_of(word) if s in self.stems]
            best = (stems[-1], 0) if stems else best
        if len(self.known) > MEMORY:
            self.known.clear()
        self.known[word] = best
        return best


def hits(text: str, automaton: Automaton) -> tuple[int, list[tuple[int, int, bool, list[str]]]]:
    """Number of words, and of each match: term, edits, whether it is quoted, and the words around it."""
    lower = text.lower()
    words = _WORD.findall(lower)
    near = {w for w in set(words) if automaton.match(w)}
    if not near:
        return len(words), []
    found, line_start = [], 0
    for i, m in enumerate(_WORD.finditer(lower)):
        if m[0] not in near:
            continue
        term, edits = automaton.match(m[0])
        line_start = lower.rfind("\n", 0, m.start()) + 1
        line_end = lower.find("\n", m.end())
        before = sum(lower.count(q, line_start, m.start()) for q in _QUOTES)
        after = sum(lower.count(q, m.end(), line_end if line_end >= 0 else len(lower)) for q in _QUOTES)
        found.append((term, edits, before % 2 == 1 and after > 0,
                      words[max(0, i - WINDOW):i] + words[i + 1:i + 1 + WINDOW]))
    return len(words), found


class Scorer:
    """The lexicon with its weights, the weights of context words, and the fitted combination."""

    def __init__(self, terms: list[str], weights: list[float]):
        self.automaton, self.weights = Automaton(terms), weights
        self.context: dict[str, float] = {}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.coefficients = np.zeros(FEATURES + 1)

    def features(self, text: str) -> list[float]:
        """Evidence of exact, misspelled and quoted terms, each weighed by its context; number of
        different terms; share of the words; balance of the context."""
        size, found = hits(text, self.automaton)
        sums, seen, balance = [0.0, 0.0, 0.0], set(), 0.0
        for term, edits, quoted, around in found:
            tone = sum(self.context.get(w, 0.0) for w in around) / max(1, len(around))
            sums[2 if quoted else edits] += self.weights[term] / (1 + exp(-2 - tone))
            balance += tone
            seen.add(term)
        return [*map(log1p, sums), log1p(len(seen)), len(found) / max(1, size), balance / max(1, len(found))]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows = np.array([self.features(t or "") for t in texts], float).reshape(-1, FEATURES)
        z = (rows - self.mean) / self.scale @ self.coefficients[1:] + self.coefficients[0]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def held_out(doc_id: str) -> Column:
    """crc32 of the id as text leaves 1 by 3; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> tuple[DataFrame, int, int]:
    """(text, toxic) of up to `size` labelled documents of each class, and the size of both classes. Only ids
    and labels are ordered, and at most 2 * `size` of them are broadcast."""
    known = labels.filter(~held_out("doc_id") & F.col("toxic").isin(0, 1)).distinct()
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = [known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for t in (0, 1)]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select("text", "toxic")
    return materialize(rows, "labelled"), totals.get(0, 0), totals.get(1, 0)


def _count(rows: DataFrame, words) -> DataFrame:
    """(word, toxic, n): in how many texts of a class a word is among `words(text)`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in chunks(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                sums.update((w, toxic) for w in set(words(text or "")))
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()),
                                          pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array(list(sums.values()), pa.int64())], ["word", "toxic", "n"])

    table = rows.mapInArrow(count, "word string, toxic int, n long")
    return table.groupBy("word").agg(*[F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).alias(f"n{t}")
                                       for t in (0, 1)])


def _entropy(n: Column, total: Column) -> Column:
    return F.when(n > 0, n * F.log(n / total)).otherwise(0.0)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on labelled documents (doc_id, text; doc_id, toxic) that aren't held out."""
    rows, clean, toxic = _sample(docs, labels, sample)
    n0, n1 = min(clean, sample), min(toxic, sample)
    if not n0 or not n1:
        scorer = Scorer([], [])
        scorer.coefficients[0] = -50.0 if not n1 else 50.0
        return scorer
    counts = _count(rows, terms_of)
    both = F.col("n0") + F.col("n1")
    # log-likelihood ratio of the word's two frequencies
    gain = 2 * (_entropy(F.col("n1"), both * n1 / (n0 + n1)) + _entropy(F.col("n0"), both * n0 / (n0 + n1)))
    ratio = ((F.col("n1") + 0.5) / (n1 + 1)) / ((F.col("n0") + 0.5) / (n0 + 1))
    lexicon = (counts.withColumn("gain", gain).withColumn("ratio", ratio)
               .filter((F.col("gain") >= EVIDENCE) & (F.col("ratio") >= RATIO))
               .orderBy(F.desc("gain"), "word").limit(TERMS).collect())
    lexicon = sorted((r["word"], log(r["ratio"])) for r in lexicon)
    scorer = Scorer([w for w, _ in lexicon], [v for _, v in lexicon])
    automaton = scorer.automaton
    around = _count(rows, lambda text: [w for *_, words in hits(text, automaton)[1] for w in words])
    tone = F.log(((F.col("n1") + 20) / (n1 + 40)) / ((F.col("n0") + 20) / (n0 + 40)))
    # context words count for what they tell beyond their frequency near terms as such
    near = around.agg(F.sum("n0").alias("a"), F.sum("n1").alias("b")).first()
    shift = log(((near["b"] or 0) + 20) / (n1 + 40)) - log(((near["a"] or 0) + 20) / (n0 + 40))
    words = (around.filter(both >= 50).select("word", (tone - shift).alias("tone"))
             .orderBy(F.desc(F.abs("tone")), "word").limit(TERMS).collect())
    scorer.context = {r["word"]: max(-1.0, min(1.0, r["tone"])) for r in words} if (near["a"] or 0) > 200 else {}
    _fit(scorer, rows, toxic / (clean + toxic))
    return scorer


def _fit(scorer: Scorer, rows: DataFrame, prior: float) -> None:
    """Logistic regression on the features of the bounded sample, set to the share of toxic labels."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values = [scorer.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column("toxic")],
                                             ["x", "toxic"])

    table = rows.mapInArrow(measure, "x array<double>, toxic int").toArrow()
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, FEATURES)
    y = table.column("toxic").to_numpy().astype(float)
    if not len(x):  # no labelled document is there
        scorer.coefficients[0] = log(prior / (1 - prior))
        return
    scorer.mean, scorer.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.column_stack([np.ones(len(x)), (x - scorer.mean) / scorer.scale])
    w, ridge = np.zeros(FEATURES + 1), np.diag([1e-3, *[0.3] * FEATURES])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    w[0] += log(prior / (1 - prior)) - log(share / (1 - share))
    scorer.coefficients = w


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", toxic_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document; `score` is the probability that it is marked toxic.

    The lexicon is learned: words and stems that are much likelier in documents marked toxic. Every word of a text is run
    through the automaton of the lexicon; matches count by their weight, less when misspelled or quoted
    (between quotation marks on their line) or among words that go with unmarked documents.

    Null or empty text scores like a text without any term. Null ids are held out; repeated rows are scored
    each. Documents or labels without a partner don't matter. If no label of a class is left to learn from, all
    documents get the score of the other class. Other columns are not used.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    marks = pick(labels, doc_id=label_id, toxic=toxic_col).withColumn("toxic", F.col("toxic").cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast(learn(rows, marks, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(values),
                 pa.array((values >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.withColumn("held_out", held_out("doc_id")).select(
        F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")

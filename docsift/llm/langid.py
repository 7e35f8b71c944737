"""Language identification with interpolated Kneser-Ney models of characters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.llm.texts import chunks, materialize, mix, pick

ORDER = 4
UNKNOWN = "und"
# Most log-probabilities in a model (types of n-grams times languages); beyond, the languages are dealt out to
# several models, and texts are scored with one after the other. No n-gram is left out.
MODEL_SIZE = 64_000_000
# Characters over which the margin between languages is counted as evidence.
EVIDENCE = 40
# A text is rejected when it is harder to predict than the training texts by so many standard deviations of
# a character, and so many of a mean over its length.
SLACK, LIMIT = 0.75, 3.0

_SYMBOL = np.array([i if chr(i).isalpha() else 32 for i in range(1 << 16)], np.uint64)
_SYMBOL[0] = 0
_START = "\0" * (ORDER - 1)


def _symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, everything else one space; 16 bits a symbol (letters beyond the
    first 65,536 code points are folded). Returns n-gram codes, the first and the end of each text."""
    joined = _START + _START.join([(t or "").replace("\0", " ").lower() for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    if len(points) and points.max() >= 1 << 16:
        high = np.flatnonzero(points >= 1 << 16)
        folded = [(p ^ (p >> 16)) & 0xFFFF | 1 if chr(p).isalpha() else 32 for p in points[high].tolist()]
        points = points.copy()
        points[high] = folded
        symbols = _SYMBOL[points]
        symbols[high] = folded
    else:
        symbols = _SYMBOL[points]
    gap = symbols == 32
    again = gap.copy()
    again[1:] &= gap[:-1]
    again[0] = False
    symbols = symbols[~again]
    marks = np.flatnonzero(symbols == 0)
    starts = marks[ORDER - 2::ORDER - 1] + 1
    ends = np.append(marks[ORDER - 1::ORDER - 1], len(symbols))
    codes = symbols.copy()
    for back in range(1, ORDER):
        codes[back:] |= symbols[:-back] << np.uint64(16 * back)
    return codes, starts, ends


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts of `docs` (text, lang); summed in each task, then shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged(parts):
            codes = np.concatenate([p[0] for p in parts])
            order = np.argsort(codes, kind="stable")
            codes, numbers = codes[order], np.concatenate([p[1] for p in parts])[order]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            return codes[first], np.add.reduceat(numbers, first)

        def flush():
            for lang, parts in held.items():
                codes, numbers = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(numbers)],
                    ["lang", "gram", "n"])
            held.clear()

        for batch in chunks(batches):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in set(langs):
                codes, starts, ends = _symbols([t for t, own in zip(texts, langs) if own == lang])
                codes = codes[codes & np.uint64(0xFFFF) != 0]
                if len(codes):
                    held.setdefault(lang, []).append(np.unique(codes, return_counts=True))
            for lang, parts in held.items():
                if len(parts) > 8:
                    held[lang] = [merged(parts)]
            if sum(len(p[0]) for parts in held.values() for p in parts) > 4_000_000:
                yield from flush()
        yield from flush()

    return (docs.mapInArrow(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


@dataclass
class HashArray:
    """Rows found by key: hashes in sorted order, with the place where each range of leading bits begins."""

    hashes: np.ndarray
    rows: np.ndarray
    shift: np.uint64 = field(init=False)
    begin: np.ndarray = field(init=False)
    deepest: int = field(init=False)

    def __post_init__(self):
        bits = max(1, int(len(self.hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        heads = (self.hashes >> self.shift).astype(np.int64)
        self.begin = np.searchsorted(heads, np.arange((1 << bits) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.begin).max())

    @classmethod
    def of(cls, keys: np.ndarray, rows: np.ndarray) -> HashArray:
        hashes = mix(keys)
        order = np.argsort(hashes)
        return cls(hashes[order], rows[order])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 if it has none."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return out
        hashes = mix(keys)
        at = self.begin[(hashes >> self.shift).astype(np.int64)]
        left, last = None, len(self.hashes) - 1
        for step in range(self.deepest):
            here = np.minimum(at + step, last)
            hit = self.hashes[here] == hashes
            if left is None:
                out[hit] = here[hit]
                left = np.flatnonzero(~hit)
            else:
                out[left[hit]] = here[hit]
                left = left[~hit]
            at, hashes = at[~hit], hashes[~hit]
            if not len(left):
                break
        return out


@dataclass
class Model:
    """Per order: log-probabilities of all n-grams seen in any language, and what a context leaves to
    the next lower order; one column per language."""

    langs: list[str]
    grams: list[HashArray]
    rests: list[HashArray]
    floor: float
    mean: np.ndarray
    deviation: np.ndarray

    def log_probabilities(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.full((len(codes), len(self.langs)), self.floor, np.float32)
        keys = codes & np.uint64((1 << 16 * order) - 1)
        row = self.grams[order].find(keys)
        table = self.grams[order].rows
        out = table[row] if len(table) else np.zeros((len(codes), len(self.langs)), np.float32)
        lost = np.flatnonzero(row < 0)
        if len(lost):
            rest = self.rests[order].find(keys[lost] >> np.uint64(16))
            lower = self.log_probabilities(codes[lost], order - 1)
            seen = rest >= 0
            lower[seen] += self.rests[order].rows[rest[seen]]
            out[lost] = lower
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Of each text: nats per character in each language, number of characters, whether it can't be judged."""
        codes, starts, ends = _symbols(texts)
        entropy = np.zeros((len(texts), len(self.langs)))
        empty = [not self.langs or not t or not any(map(str.isalpha, t)) for t in texts]
        full = np.flatnonzero(ends > starts)
        if self.langs and len(full):
            inside = np.ones(len(codes), bool)
            inside[(codes & np.uint64(0xFFFF)) == 0] = False
            sums = np.add.reduceat(self.log_probabilities(codes[inside]),
                                   (np.cumsum(inside) - 1)[starts[full]], axis=0, dtype=np.float64)
            entropy[full] = -sums / (ends - starts)[full, None]
        return entropy, np.maximum(ends - starts, 1), empty


@dataclass
class Verdict:
    """The languages of all models, and what their training texts cost."""

    langs: list[str]
    mean: np.ndarray
    deviation: np.ndarray

    def judge(self, entropy: np.ndarray, length: np.ndarray, empty: list[bool]
              ) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: language, score, nats per character, whether it is rejected."""
        if not self.langs:
            entropy = np.zeros((len(length), 1))
        best = entropy.argmin(1)
        low = entropy[np.arange(len(length)), best]
        odds = np.exp(np.maximum(-(entropy - low[:, None]) * np.minimum(length, EVIDENCE)[:, None], -60)).sum(1)
        if self.langs:
            hard = low > self.mean[best] + self.deviation[best] * (SLACK + LIMIT / np.sqrt(length))
        else:
            hard = np.ones(len(length), bool)
        return ([UNKNOWN if e else self.langs[b] for e, b in zip(empty, best.tolist())],
                np.where(empty, 0.0, 1 / odds), np.where(empty, np.nan, low), hard | np.array(empty, bool))


def models(grams: DataFrame, model_size: int | None = None) -> Iterator[Model]:
    """Models of at most `model_size` entries, of one language at least; their languages in order. Each is made
    when it is asked for, so that the driver holds one at a time. No training text: one model without languages.

    A language's probabilities come from its own counts alone, so they are the same in any of the models.
    """
    grams = materialize(grams.filter(F.col("lang").isNotNull()), "grams")
    blocks: list[list[str]] = [[]]
    rows = 0
    for lang, n in sorted(map(tuple, grams.groupBy("lang").count().collect())):
        if blocks[-1] and (rows + n) * (len(blocks[-1]) + 1) > (model_size or MODEL_SIZE):
            blocks.append([])
            rows = 0
        blocks[-1].append(lang)
        rows += n
    letters = grams.select(F.col("gram").bitwiseAND(0xFFFF)).distinct().count()
    for langs in blocks:
        yield _fit(grams.filter(F.col("lang").isin(langs)) if len(blocks) > 1 else grams, langs, letters)


def fit(grams: DataFrame) -> Model:
    """One model of all languages."""
    return next(models(grams, 1 << 62))


def _fit(grams: DataFrame, langs: list[str], letters: int) -> Model:
    """Kneser-Ney from the counts of the highest order; lower orders count distinct left neighbours."""
    table = grams.select("lang", "gram", "n").toArrow()
    lang_of = np.array([langs.index(x) for x in table.column("lang").unique().to_pylist()], np.int64)
    own = lang_of[table.column("lang").combine_chunks().dictionary_encode().indices.to_numpy()] if len(table) else (
        np.zeros(0, np.int64))
    codes = table.column("gram").to_numpy().view(np.uint64)
    counts = table.column("n").to_numpy().astype(np.float64)

    levels: dict[int, tuple] = {ORDER: (own, codes, counts)}
    for order in range(ORDER - 1, 0, -1):
        above_lang, above, _ = levels[order + 1]
        pairs = np.stack([above_lang.astype(np.uint64), above & np.uint64((1 << 16 * order) - 1)])
        keys, numbers = np.unique(pairs, axis=1, return_counts=True)
        kept = (keys[1] & np.uint64(0xFFFF)) != 0
        levels[order] = (keys[0][kept].astype(np.int64), keys[1][kept], numbers[kept].astype(np.float64))

    size = len(langs)
    floor = -float(np.log(max(1, letters) + 1))
    model = Model(langs, [None] * (ORDER + 1), [None] * (ORDER + 1), floor, np.zeros(size), np.ones(size))
    for order in range(1, ORDER + 1):
        lang, keys, numbers = levels[order]
        contexts, which = np.unique(keys >> np.uint64(16), return_inverse=True)
        total, kinds = np.zeros((len(contexts), size)), np.zeros((len(contexts), size))
        np.add.at(total, (which, lang), numbers)
        np.add.at(kinds, (which, lang), 1)
        once, twice = (np.bincount(lang[numbers == k], minlength=size) for k in (1, 2))
        discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(total > 0, np.minimum(discount * kinds / total, 1), 1)
        share = np.maximum(share, 1e-6)
        model.rests[order] = HashArray.of(contexts, np.log(share).astype(np.float32))
        types, place = np.unique(keys, return_inverse=True)
        direct = np.zeros((len(types), size))
        direct[place, lang] = np.maximum(numbers - discount[lang], 0) / np.maximum(total[which, lang], 1)
        context = np.searchsorted(contexts, types >> np.uint64(16))
        lower = np.exp(model.log_probabilities(types, order - 1).astype(np.float64))
        model.grams[order] = HashArray.of(
            types, np.log(direct + share[context] * lower).astype(np.float32) if len(types)
            else np.zeros((0, size), np.float32))
    if len(codes):
        cost = -model.log_probabilities(codes)[np.arange(len(codes)), own].astype(np.float64)
        weight = np.maximum(np.bincount(own, counts, size), 1)
        model.mean = np.bincount(own, counts * cost, size) / weight
        model.deviation = np.sqrt(np.maximum(np.bincount(own, counts * cost ** 2, size) / weight - model.mean ** 2, 0))
    return model


def _judged(docs: DataFrame, parts: Iterable[Model], text_col: str, out, schema) -> DataFrame:
    """`out(batch, judged)` of the batches of `docs`. Where there are several models, each but the last one is
    a pass of its own, which adds its entropies to the rows; so a task holds one model."""
    carry = "entropies"
    while carry in docs.columns:
        carry += "_"

    def entropies(batch: pa.RecordBatch, model: Model):
        own = model.entropies(batch.column(text_col).to_pylist())
        if carry not in batch.schema.names:
            return own
        before = batch.column(carry).flatten().to_numpy().reshape(batch.num_rows, -1)
        return np.hstack((before, own[0])), *own[1:]

    def adds(shared):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, text_col):
                held = pa.array(list(entropies(batch, shared.value)[0]), pa.list_(pa.float64()))
                rest = [c for c in batch.schema.names if c != carry]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), held], [*rest, carry])
        return add

    sent: list = []
    langs, mean, deviation = [], [], []
    for model in parts:
        if sent:
            fields = T.StructType([f for f in docs.schema if f.name != carry]).add(carry, T.ArrayType(T.DoubleType()))
            docs = materialize(docs.mapInArrow(adds(sent[-1]), fields), "entropies")
            sent.pop().unpersist()
        sent.append(docs.sparkSession.sparkContext.broadcast(model))
        langs += model.langs
        mean, deviation = np.append(mean, model.mean), np.append(deviation, model.deviation)
    shared, verdict = sent[-1], Verdict(langs, mean, deviation)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            judged = verdict.judge(*entropies(batch, shared.value))
            yield out(batch.drop_columns([carry]) if carry in batch.schema.names else batch, judged)

    return docs.mapInArrow(judge, schema)


def predict(docs: DataFrame, parts: Iterable[Model], carried: str = "doc_id long") -> DataFrame:
    """`carried` columns of `docs` with lang_pred, score, entropy (nats per character) and rejected."""
    names = [c.split()[0] for c in carried.split(", ")]

    def score(batch: pa.RecordBatch, judged) -> pa.RecordBatch:
        best, score, entropy, rejected = judged
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(best, pa.string()), pa.array(score), pa.array(entropy),
             pa.array(rejected)], [*names, "lang_pred", "score", "entropy", "rejected"])

    return _judged(docs, parts, "text", score,
                   f"{carried}, lang_pred string, score double, entropy double, rejected boolean")


def held_out(doc_id: str) -> F.Column:
    """crc32 of the id as text leaves 2 by 4; a null id is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predict the language of every whole text; learn from the labelled texts that aren't held out.

    Characters are lower-cased letters and single spaces. One model per language of order 4, with absolute
    discounts from the counts of counts; all counts cover all training texts. The language with the lowest
    cross-entropy per character wins; equal ones go by name. `score` weighs it against the others.
    `rejected`: no letter, or much harder to predict than the training texts of the chosen language.

    Null or letterless text: `und`, score 0, rejected. No training text: everything is `und`. Rows are
    scored one by one, so repeated rows and null ids stay. Other columns are not used.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("held_out", held_out("doc_id"))
    training = rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(rows.select("doc_id", "held_out", "text"), models(count_grams(training.select("text", "lang"))),
                   "doc_id long, held_out boolean")


def drop_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """The rows of `docs`, with all columns, that `identify` doesn't reject. Row by row, without a shuffle; with
    no training text nothing can be judged, and only texts without letters go."""
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    training = rows.filter(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = models(count_grams(training.select("text", "lang")))
    first = next(parts)
    if not first.langs:
        return docs.filter(F.col(f"`{text_col}`").rlike(r"\p{L}"))
    parts = chain([first], parts)
    del first
    return _judged(docs, parts, text_col, lambda batch, judged: batch.filter(pa.array(~judged[3])), docs.schema)

"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import hash_words, mix, pick, text_bytes

# Samples in a fingerprint; each is kept as 16 bits.
SAMPLES = 64
# Bytes of text whose terms are sampled together.
BLOCK = 2 << 20

_NONE = np.zeros(SAMPLES, np.uint16)


def _samples(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each weighted term and sample: ln a, and the 16-bit code of (term, t).

    Ioffe's sampling: r and c are Gamma(2, 1), b uniform, all from hashes of term and sample;
    t = floor(ln w / r + b), ln a = ln c - r (t - b) - r. The term of smallest a is the sample, and two
    weighted sets have the same one with the probability of their generalised Jaccard similarity.
    """
    size = len(terms)
    costs, codes = np.empty((size, SAMPLES), np.float32), np.empty((size, SAMPLES), np.uint16)
    logs = np.log(weights.astype(np.float32))
    unit = np.float32(2.0 ** -32)

    def gamma(x: np.ndarray) -> np.ndarray:
        high, low = (x >> np.uint64(32)).astype(np.float32), (x & np.uint64(0xFFFFFFFF)).astype(np.float32)
        return -np.log((high + np.float32(0.5)) * unit * ((low + np.float32(0.5)) * unit))

    for k in range(SAMPLES):
        r, c, x = gamma(mix(terms, 3 * k + 11)), gamma(mix(terms, 3 * k + 12)), mix(terms, 3 * k + 13)
        b = (x >> np.uint64(32)).astype(np.float32) * unit
        t = np.floor(logs / r + b)
        costs[:, k] = np.log(c) - r * (t - b) - r
        codes[:, k] = (x & np.uint64(0xFFFF)).astype(np.uint16) ^ (t.astype(np.int32) * 40503).astype(np.uint16)
    return costs, codes


def signatures(texts: list[str]) -> list[np.ndarray]:
    """The samples of each text; its terms are its words, weighted by how often they occur. A text
    without words has none of them, all zero."""
    hashes, _, _, first = hash_words(*text_bytes(pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary())))
    bags = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    terms, weights = (np.concatenate([b[i] for b in bags]) if bags else hashes for i in range(2))
    if not len(terms):
        return [_NONE] * len(texts)
    _, one, where = np.unique(mix(terms + weights.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                              return_index=True, return_inverse=True)
    costs, codes = _samples(terms[one], weights[one])
    out, at, each = [], 0, np.arange(SAMPLES)
    for bag in bags:
        rows = where[at:at + len(bag[0])]
        at += len(rows)
        out.append(codes[rows[costs[rows].argmin(0)], each] if len(rows) else _NONE)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples; a text without words is like another such one only."""
    if (a is _NONE) != (b is _NONE):
        return 0.0
    return float((a == b).mean())


def _text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, other: str) -> str:
    """The last half of the code points replaced by the first as many of another text."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def _in_order(docs: DataFrame, parts: int) -> DataFrame:
    """(part, tail, doc_id, text): rows in ranges of ids, each range in descending order with the row that
    comes after it as its tail (tail = 1; the last range has the first row of all).

    The ranges come from approximate quantiles of the ids. Per range only its largest id, and the first text
    under that id, are looked up; all text is shuffled once.
    """
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)))
    place = F.lit(-1)
    if bounds:
        place = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("doc_id")))
    rows = docs.withColumn("part", F.when(F.col("doc_id").isNull(), -2).otherwise(place))
    tops = rows.groupBy("part").agg(F.max("doc_id").alias("top"))
    found = sorted((r["part"], r["top"]) for r in tops.collect())  # one row per range
    if not found:
        return rows.select("part", F.lit(0).alias("tail"), "doc_id", "text")
    above = [found[(i + 1) % len(found)][0] for i in range(len(found))]
    spark = docs.sparkSession
    heads = F.broadcast(spark.createDataFrame([(p, t, a) for (p, t), a in zip(found, above)],
                                              "part int, top long, above int"))
    led = rows.join(heads, "part")
    at_top = F.col("doc_id").eqNullSafe(F.col("top"))
    first = F.broadcast(led.filter(at_top).groupBy("part").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("lead")))
    led = led.join(first, "part")
    lead = at_top & F.coalesce("text", F.lit("")).eqNullSafe(F.col("lead"))
    own, after = F.struct("part", F.lit(0).alias("tail")), F.struct(F.col("above").alias("part"), F.lit(1).alias("tail"))
    return led.select(F.explode(F.when(lead, F.array(own, after)).otherwise(F.array(own))).alias("at"),
                      "doc_id", "text").select("at.*", "doc_id", "text")


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    waiting: list[tuple[int | None, str]] = []  # rows of one range, the last of which waits for its next
    part, size, closed = None, 0, False

    def results():
        texts = [t for _, t in waiting]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        own = signatures(texts)
        other = signatures(changed)
        columns = [[], [], [], [], [], [], []]
        for (doc, text), new, s, e, n in zip(waiting, changed, own, other, own[1:]):
            if new == text:
                e = s
            for column, value in zip(columns, (
                    doc, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), _text(s), _text(e),
                    likeness(s, e), likeness(s, n))):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for at, tail, doc, text in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text"))):
            if at != part:
                if len(waiting) > 1:
                    yield results()
                waiting, part, size, closed = [], at, 0, False
            if closed:
                continue
            closed = tail == 1
            waiting.append((doc, text or ""))
            size += len(text or "")
            if size > BLOCK:
                if len(waiting) > 1:
                    yield results()
                waiting, size = waiting[-1:], 0
    if len(waiting) > 1:
        yield results()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its length in code points, the digest of its edited text (see `edited`; the other
    text is the next document's by descending id, after the last the first), the fingerprints of both as hexadecimal
    text, and the likeness of its own to that of the edited text and to the next document's.

    Terms are words, weighted by their number; equal texts have equal fingerprints. The likeness is an
    unbiased estimate of the generalised Jaccard similarity with a standard deviation of at most 1/16.

    Null text is empty. Rows with the same id are ordered by text, null first; null ids come last. A single
    document is its own next. No documents: no rows. Other columns are not used.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = _in_order(rows, parts).repartition(parts, "part").sortWithinPartitions(
        "part", "tail", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(_fingerprint, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                            "edited_fingerprint string, near_edited double, near_next double")

"""Helpers shared by the operators: whole texts as byte arrays, word and shingle hashes, shared storage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.session import materialize

__all__ = ["CHUNK", "WORDS", "chunks", "hash_words", "materialize", "mix", "pick", "rolling",
           "shingle_hashes", "shingle_sets", "small_batches", "spans", "text_bytes"]

# Bytes of text that a task works on at a time. A longer text is one chunk of its own.
CHUNK = 1 << 20
# Bytes of a batch of rows on its way to a Python worker, and the setting that bounds them.
BATCH, BATCH_SETTING = 2 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"
# Words in a shingle.
WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns cannot clash."""
    return docs.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def small_batches(spark: SparkSession) -> None:
    """From now on batches of this session hold at most `BATCH` bytes, or one row. By default they are cut at 10,000 rows:
    the whole texts of a partition, which lie in the JVM and in the worker several times over. A smaller bound
    in bytes that the session already has stays."""
    now = spark.conf.get(BATCH_SETTING, None) or ""
    if not now.isdigit() or not 0 < int(now) <= BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well mixed 64-bit hash of each number (the finaliser of splitmix64)."""
    x = x + np.uint64((seed * _BASE + 0x632BE59BD9B4E019) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one more entry: the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each add up to about `size` bytes.

    After the last one, what earlier batches took goes back to the system: a worker waits for tasks of later stages
    and would keep it meanwhile.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    batch = None
    pa.default_memory_pool().release_unused()


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of bytes other than ASCII white space, A-Z lower-cased, and never cross texts.

    Returns the 64-bit hash, start and end of each word, and the number of words before each text.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    left = edge[:-1].copy()
    left[0] = True
    left[1:] |= space[:-1]
    right = edge[1:].copy()
    right[-1] = True
    right[:-1] |= space[1:]
    word = ~space
    starts = np.flatnonzero(word & left)
    ends = np.flatnonzero(word & right) + 1
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    powers, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = sums[1:]
    terms[:] = data
    terms += np.uint64(1)
    terms *= powers[:-1]
    np.cumsum(terms, out=terms)
    return sums, inverse


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for the `size` bytes at each place."""
    sums, inverse = _sums(data)
    out = sums[size:] - sums[:-size]
    out *= inverse[:len(data) - size + 1]
    return out


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for the bytes of each span."""
    sums, inverse = _sums(data)
    return (sums[ends] - sums[starts]) * inverse[starts]


def _combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total = total * np.uint64(_BASE) + hashes[i:i + size]
    return mix(total, n)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Per text: the hash of each shingle, in order. Fewer words than a shingle make one of them all."""
    runs = _combine(hashes, words) if len(hashes) >= words else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        out.append(runs[a:b - words + 1] if b - a >= words
                   else _combine(hashes[a:b], b - a) if b > a else runs[:0])
    return out


def shingle_sets(column: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Per text: its distinct shingle hashes, sorted."""
    hashes, _, _, first = hash_words(*text_bytes(column))
    return [np.unique(s) for s in shingle_hashes(hashes, first, words)]

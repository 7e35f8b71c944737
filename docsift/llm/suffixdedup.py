"""Removal of byte strings that repeat across documents, with suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.jaccard import runs
from docsift.llm.texts import chunks, materialize, mix, pick, rolling, spans, text_bytes
from docsift.session import release

# Length of a string that counts as repeated.
LENGTH = 50
# Each string is filed under the smallest hash of its grams of so many bytes.
GRAM = 24
# Bytes of text whose repeats within a task are settled before the shuffle. A worker needs some 60 bytes for each.
BLOCK = 1 << 20
# Bytes of segments in one suffix array; segments under one hash beyond that are settled string by string.
ARRAY = 2 << 20
# Bytes of several hashes that are put into one array together. A worker needs some 60 bytes for each.
TOGETHER = 512 << 10

_LAST = (1 << 63) - 1


def _filed(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(hash, text, start, n): runs of n strings, starting one byte apart, that have the same smallest hash of
    a gram. Equal strings have equal hashes, so they are under the same hash everywhere."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    width = length - GRAM + 1
    low = mix(rolling(data, GRAM), 21)
    step = 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if width > step:
        low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
    sizes = np.diff(offsets)
    texts = np.flatnonzero(sizes >= length)
    valid = np.zeros(len(low) + 1, np.int8)
    np.add.at(valid, offsets[texts], 1)
    np.add.at(valid, offsets[texts + 1] - length + 1, -1)
    valid = np.cumsum(valid[:-1], dtype=np.int8) > 0
    begin = valid.copy()
    begin[1:] &= (low[1:] != low[:-1]) | ~valid[:-1]
    begin[offsets[texts]] = True
    starts = np.flatnonzero(begin)
    if not len(starts):
        return none.astype(np.uint64), none, none, none
    text = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(low)), offsets[text + 1] - length + 1)
    return low[starts], text, starts, ends - starts


def _postings(length: int):
    """(h, node, n, direct): the hashes of each text (`node`). Of the texts that have one within a block, the
    first and the last go on to meet those of other blocks; all others are known to share it (`direct`)."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=BLOCK):
            data, offsets = text_bytes(batch.column("text"))
            h, text, _, _ = _filed(data, offsets, length)
            node = batch.column("node").to_numpy()[text]
            order = np.lexsort((node, h))
            h, node = h[order], node[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
            h, node = h[fresh], node[fresh]
            first = np.ones(len(h), bool)
            first[1:] = h[1:] != h[:-1]
            last = np.append(first[1:], True)[:len(h)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(node), pa.array(np.zeros(len(h), np.int32)),
                 pa.array(~(first | last))], ["h", "node", "n", "direct"])

    return post


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, node) of hashes that at least two different texts have."""
    batches = iter(batches)
    known: list[pa.RecordBatch] = []

    def open_rows():
        for batch in batches:
            direct = batch.column("direct")
            yield batch.filter(pc.invert(direct)).select(["h", "node", "n"])
            if direct.true_count:
                known.append(batch.filter(direct))
                return

    for found in runs(open_rows()):
        yield found.select(["h", "node"])
    # direct rows stand behind all others
    for batch in chain(known, batches):
        yield batch.select(["h", "node"])


def _bytes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The byte strings that begin at `starts`."""
    ends = np.cumsum(sizes)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)),
                                   pa.py_buffer(data[np.repeat(starts, sizes) + inside])])


def _segments(length: int):
    """(direct, h, s, doc, th, start, n, segment): the runs of strings under hashes that documents share; `s` is
    a hash of the segment, with which it and `h` tell its content. Of equal segments in a block only
    those of the smallest id go on; the others are removed as a whole (`direct`)."""
    names = ["direct", "h", "s", "doc", "th", "start", "n", "segment"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=BLOCK):
            data, offsets = text_bytes(batch.column("text"))
            h, text, start, n = _filed(data, offsets, length)
            lists = batch.column("hs")
            known = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            wanted = np.isin(mix(h + mix(text.astype(np.uint64), 22)), mix(known + mix(owner.astype(np.uint64), 22)))
            h, text, start, n = h[wanted], text[wanted], start[wanted], n[wanted]
            if not len(h):
                continue
            sizes = n + length - 1
            s = mix(spans(data, start, start + sizes) + sizes.astype(np.uint64), 23)
            doc, th = batch.column("doc").to_numpy()[text], batch.column("th").to_numpy()[text]
            order = np.lexsort((doc, s, h))
            first = np.append(True, (h[order][1:] != h[order][:-1]) | (s[order][1:] != s[order][:-1]))
            least = doc[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            direct = np.empty(len(order), bool)
            direct[order] = doc[order] > least
            # neighbouring runs that go as a whole are one
            joined = np.zeros(len(h), bool)
            joined[1:] = direct[1:] & direct[:-1] & (text[1:] == text[:-1]) & (start[1:] == (start + n)[:-1])
            n = np.add.reduceat(n, np.flatnonzero(~joined))
            h, s, doc, th, start, text, direct, sizes = (
                v[~joined] for v in (h, s, doc, th, start, text, direct, sizes))
            h, s = np.where(direct, 0, h).astype(np.uint64), np.where(direct, 0, s).astype(np.uint64)
            segment = _bytes_of(data, start, np.where(direct, 0, sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(direct), pa.array(h.view(np.int64)), pa.array(s.view(np.int64)), pa.array(doc), pa.array(th),
                 pa.array(start - offsets[text]), pa.array(n), segment], names)

    return cut


def words8(text: np.ndarray, behind: int = 0) -> np.ndarray:
    """The eight bytes at each place, and at `behind` places after the last, as one big-endian number; zeros behind
    the end."""
    size = len(text) + behind
    padded = np.concatenate((text, np.zeros(behind + 8, np.uint8)))
    out = np.zeros(size, np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out |= padded[k:k + size]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of `text` in the order of their suffixes, compared over at least `depth` bytes.

    Two-stage sorting: only suffixes that are smaller than their successor are sorted, eight bytes at a time
    and then only where still tied. The others follow from a scan over the buckets of first bytes in
    ascending order: behind each sorted suffix, the suffix one place before it is the next of its bucket.
    """
    size = len(text)
    if not size:
        return np.zeros(0, np.int64)
    kind = np.int32 if size < 1 << 31 else np.int64
    last = np.flatnonzero(np.append(text[1:] != text[:-1], True)).astype(kind)  # of each run of one letter
    smaller = np.repeat(np.append(text[last[1:]], np.uint8(0)) > text[last], np.diff(last, prepend=-1))
    order = np.flatnonzero(smaller).astype(kind)
    del last, smaller
    words = words8(text, depth + 8)
    order = order[np.argsort(words[order], kind="stable")]
    group = np.cumsum(np.append(True, words[order][1:] != words[order][:-1]), dtype=kind) if len(order) else order
    for at in range(8, depth, 8):
        tied = np.zeros(len(order), bool)
        if len(order):
            tied[1:] = group[1:] == group[:-1]
            tied[:-1] |= tied[1:].copy()
        places = np.flatnonzero(tied)
        if not len(places):
            break
        keys = words[order[places] + at]
        inner = np.lexsort((keys, group[places]))
        order[places] = order[places][inner]
        keys, own = keys[inner], group[places]
        fresh = np.ones(len(order), bool)
        fresh[1:] = group[1:] != group[:-1]
        fresh[places[1:]] |= (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
        group = np.cumsum(fresh, dtype=kind)
    del words, group
    borders = np.searchsorted(text[order], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([size - 1], kind))
    out = []
    for c in range(256):
        larger, waiting[c] = waiting[c], []
        new = np.concatenate(larger) if larger else np.zeros(0, kind)
        while len(new):
            before = new[new > 0] - 1
            new = before[text[before] == c]
            if len(new):
                larger.append(new)
        bucket = np.concatenate([*larger, order[borders[c]:borders[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        letters = text[before]
        before, letters = before[letters > c], letters[letters > c]
        by = np.argsort(letters, kind="stable")
        before, letters = before[by], letters[by]
        cuts = np.flatnonzero(np.append(True, letters[1:] != letters[:-1])) if len(letters) else []
        for a, b in zip(cuts, [*cuts[1:], len(letters)]):
            waiting[letters[a]].append(before[a:b])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it, up to `most`; 0 for the first."""
    words = words8(text, most + 8)
    out = np.zeros(len(order), np.int32)
    open_rows = np.arange(1, len(order), dtype=order.dtype)
    for at in range(0, most, 8):
        if not len(open_rows):
            break
        x = words[order[open_rows] + at] ^ words[order[open_rows - 1] + at]
        same = np.zeros(len(x), np.int32)
        for k in range(1, 9):
            same += x >> np.uint64(64 - 8 * k) == 0
        out[open_rows] += same
        open_rows = open_rows[same == 8]
    return np.minimum(out, most)


def _sources(text: np.ndarray, offsets: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(segment, place in it, n): runs of strings of the segments that also occur in one of a smaller id."""
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
    string = np.ones(len(text), bool)
    for k in range(1, length):  # the last places of a segment begin none
        string[offsets[1:][sizes >= k] - k] = False
    order = suffix_array(text, length + 6)
    group = np.flatnonzero(common_prefixes(text, order, length) < length)
    least = np.minimum.reduceat(np.where(string, docs[owner], _LAST)[order], group)
    smallest = np.empty(len(text), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(group, len(order))))
    del order, group, least
    # strings of different segments never touch, since the last places of a segment are none
    edge = np.diff(np.concatenate(([False], (smallest < docs[owner]) & string, [False])).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return owner[begin], begin - offsets[owner[begin]], end - begin


_SETTLED = ["doc", "th", "start", "n", "segment"]


def _settle(length: int, array: int):
    """(doc, th, start, n): runs of strings that occur under a smaller id. Rows come ordered by hash and
    segment, the smallest id first. Segments under one hash that do not fit into an array are
    passed on with their bytes (`segment`) instead."""

    def removed(rows: pa.Table, mask: np.ndarray | None = None, keep: bool = False) -> pa.RecordBatch:
        rows = rows if mask is None else rows.filter(pa.array(mask))
        columns = [rows.column(c).combine_chunks() for c in _SETTLED[:4]]
        segment = rows.column("segment").combine_chunks() if keep else pa.nulls(len(rows), pa.binary())
        return pa.RecordBatch.from_arrays([*columns, segment], _SETTLED)

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole hashes."""
        h, s, doc = (rows.column(c).to_numpy() for c in ("h", "s", "doc"))
        first = np.append(True, (h[1:] != h[:-1]) | (s[1:] != s[:-1]))
        later = doc > doc[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
        yield removed(rows, later)
        rows = rows.filter(pa.array(~later))
        h = rows.column("h").to_numpy()
        begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = pc.binary_length(rows.column("segment")).to_numpy(zero_copy_only=False).astype(np.int64)
        large = np.repeat(np.add.reduceat(sizes, begin) > array, np.diff(np.append(begin, len(h))))
        if large.any():
            yield removed(rows, large, keep=True)
            rows = rows.filter(pa.array(~large))
        h = rows.column("h").to_numpy()
        ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)) if len(h) else []
        bytes_to = np.append(0, np.cumsum(sizes[~large]))
        start = 0
        while start < len(h):
            stop = ends[max(np.searchsorted(ends, start, "right"),
                            np.searchsorted(bytes_to[ends], bytes_to[start] + min(array, TOGETHER), "right") - 1)]
            yield arrays(rows.slice(start, stop - start))
            start = stop

    def arrays(rows: pa.Table) -> pa.RecordBatch:
        """Whole hashes that fit into an array."""
        text, offsets = text_bytes(rows.column("segment"))
        at, place, n = _sources(text, offsets, rows.column("doc").to_numpy(), length)
        return pa.RecordBatch.from_arrays(
            [rows.column("doc").combine_chunks().take(pa.array(at)), rows.column("th").combine_chunks().take(pa.array(at)),
             pa.array(rows.column("start").to_numpy()[at] + place), pa.array(n), pa.nulls(len(at), pa.binary())],
            _SETTLED)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            direct = batch.column("direct")
            if direct.true_count:
                yield removed(pa.Table.from_batches([batch.filter(direct)]))
            batch = batch.filter(pc.invert(direct))
            if batch.num_rows and held and size > array:
                # the hash that may go on stays; one that is too large by itself is never held as a whole
                rows = pa.Table.from_batches(held)
                h = rows.column("h").to_numpy()
                border = int(np.searchsorted(h, h[-1])) if h[0] != h[-1] else 0
                if border:
                    yield from solve(rows.slice(0, border))
                    held = rows.slice(border).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
                if size > array:
                    rows = pa.Table.from_batches(held)
                    yield removed(rows, keep=True)
                    spilled.add(int(h[-1]))
                    held, size = [], 0
            if batch.num_rows and spilled:
                over = pc.is_in(batch.column("h"), pa.array(spilled, pa.int64()))
                if pc.any(over).as_py():
                    yield removed(pa.Table.from_batches([batch.filter(over)]), keep=True)
                    batch = batch.filter(pc.invert(over))
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
        if held:
            yield from solve(pa.Table.from_batches(held))

    spilled: set[int] = set()
    return settle


def _one_by_one(rows: DataFrame, length: int) -> DataFrame:
    """Segments of overfull hashes: each string is looked up by itself. Strings are summed up to their
    smallest id before the shuffle, so no task gets all segments of a hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(segment[i:i + length], doc, th, start + i)
                     for doc, th, start, n, segment in zip(*(batch.column(c).to_pylist() for c in (
                         "doc", "th", "start", "n", "segment"))) for i in range(n)]
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
                                             ["string", "doc", "th", "start"])

    every = materialize(rows.mapInArrow(strings, "string binary, doc long, th long, start long"), "strings")
    least = every.groupBy("string").agg(F.min("doc").alias("least"))
    return every.join(least, "string").filter("doc > least").select(
        "doc", "th", "start", F.lit(1).cast("long").alias("n"))


def _remove(length: int):
    """Cut the covered bytes out of each text."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, size=BLOCK):
            kept, spans = [], []
            cuts = batch.column("cuts")
            start, n = (cuts.flatten().field(i).to_numpy() for i in range(2))
            ends = np.cumsum(pc.list_value_length(cuts).to_numpy(zero_copy_only=False))
            for text, a, b in zip(batch.column("text").to_pylist(), np.append(0, ends[:-1]), ends):
                raw = np.frombuffer(text.encode("utf-8"), np.uint8)
                change = np.zeros(len(raw) + 1, np.int32)
                np.add.at(change, start[a:b], 1)
                np.add.at(change, start[a:b] + n[a:b] - 1 + length, -1)
                covered = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
                spans.append([{"start": a, "length": b - a} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
                kept.append(raw[~covered].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("th"), pa.array(kept, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                ["doc", "th", "kept", "spans"])

    return remove


def find_repeats(docs: DataFrame, length: int = LENGTH, array: int = ARRAY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, th, kept, spans) of each document that loses bytes: what is left of its UTF-8 bytes, and the
    removed runs (start, length). A byte goes if a string of `length` bytes over it also starts in a document
    with a smaller id. Strings are judged on the whole input and never cross documents. `th` is
    xxhash64 of the text, which tells rows with the same id apart.

    Of equal texts only the one with the smallest id is looked at; the others go as a whole. Every string is filed
    under the smallest hash of its 24-byte grams, so equal strings come together whatever stands around them. Only
    hashes that two texts share go on: with the bytes around them they are put
    into suffix arrays, where equal strings are neighbours and the smallest id among them decides. Copies are
    settled within a task's block first, so a text or line that a third of all documents share is
    no hot key, and a hash under which too many different segments lie is settled string by string.

    Null or short text loses nothing. Null ids come after all others. Rows with the same id don't remove
    from each other. Other columns are not used.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("th"),
        F.xxhash64(F.lit(1), "text").alias("tx"), "text")
    classes = materialize(rows.groupBy("th", "tx").agg(F.min("doc").alias("first")), "classes")
    posted = rows.select(F.col("th").alias("node"), "text").mapInArrow(
        _postings(length), "h long, node long, n int, direct boolean")
    shared = (posted.repartition(F.when(F.col("direct"), F.col("node")).otherwise(F.col("h")))
              .sortWithinPartitions("direct", "h", "node").mapInArrow(_shared, "h long, node long"))
    hashes = shared.groupBy(F.col("node").alias("th")).agg(F.collect_set("h").alias("hs"))
    wanted = materialize(hashes.join(classes, "th").withColumnRenamed("first", "doc"), "hashes")
    release(docs.sparkSession)  # the hashes of all texts, the largest part
    held = materialize(rows.join(wanted, ["doc", "th", "tx"]).select("doc", "th", "text", "hs"), "held")
    cut = held.mapInArrow(_segments(length), "direct boolean, h long, s long, doc long, th long, start long, n long, "
                                             "segment binary")
    settled = (cut.repartition(F.when(F.col("direct"), F.col("doc")).otherwise(F.col("h")))
               .sortWithinPartitions("direct", "h", "s", "doc")
               .mapInArrow(_settle(length, array), "doc long, th long, start long, n long, segment binary"))
    release(docs.sparkSession)
    settled = materialize(settled, "settled")
    release(docs.sparkSession)  # the segments
    done = settled.filter("segment is null").drop("segment")
    large = settled.filter("segment is not null")
    if not large.isEmpty():
        done = done.unionByName(_one_by_one(large, length))
    cuts = done.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "n")).alias("cuts"))
    out = held.select("doc", "th", "text").join(cuts, ["doc", "th"]).mapInArrow(
        _remove(length), "doc long, th long, kept binary, spans array<struct<start: long, length: long>>")
    size = F.octet_length("text").cast("long")
    copies = rows.filter(size >= length).select("doc", "th", "tx", size.alias("size")).join(
        classes, ["th", "tx"]).filter("doc > first").select(
            "doc", "th", F.lit(b"").alias("kept"), F.array(F.struct(F.lit(0).cast("long").alias("start"),
                                                                    F.col("size").alias("length"))).alias("spans"))
    return out.unionByName(copies).select(
        F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "th", "kept", "spans")


def digests(docs: DataFrame, repeats: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, and the digest of what is left. Texts aren't moved:
    only lengths and digests are joined."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    lost = repeats.select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")).dropDuplicates(
            ["_id", "_th"])
    return whole.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))

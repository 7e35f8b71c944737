"""Similarity join on word shingles: subsets for small sets, inverted lists for large ones."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.components import components
from docsift.llm.texts import WORDS, chunks, materialize, mix, pick, shingle_sets

# Documents link when SHARE * union <= 100 * intersection.
SHARE = 75
# Largest set for which subsets are considered at all.
LARGEST_SMALL = 14
# Shingles that a task counts together, and in how many different sets one must be to be reported as common.
COUNTED, COMMON = 8_000_000, 2
# Most common shingles that are told to the tasks (12 bytes each). They only set the order in which
# shingles are indexed; the result is the same with any number of them.
TOLD = 2_000_000


def _needed(n: int, share: int = SHARE) -> int:
    """Shingles that a set of n must have in common with any linked set, at least."""
    return -(-share * n // 100)


def _levels(n: int, largest: int, share: int = SHARE) -> range:
    """Sizes of subsets that a small set of n shares with a linked set that is at least as large, and of
    those that it shares with smaller ones: one size for each size that the larger set can have."""
    return range(_needed(n, share), min(_needed(min(n * 100 // share, largest), share), n) + 1)


def _nodes(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit number for each set; sets with the same shingles have the same."""
    return np.array([int(mix(mix(s, 1).sum(keepdims=True) + np.uint64(len(s)), 2)[0]) if len(s) else 0
                     for s in sets], np.uint64).view(np.int64)


def _survey(docs: DataFrame, words: int) -> DataFrame:
    """One pass over the texts. Rows of kind 0: (id, n, node) of each document. Kind 1: common shingles
    (x) and how often they occur (n). Kind 2: set sizes up to the largest small one (x), how many sets
    have it (n) and the total length of the inverted lists that they stand in (y)."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def rows(kind, x, n, y, ids=None):
            size = len(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, kind, np.int32)), ids or pa.nulls(size, pa.int64()),
                 pa.array(np.asarray(x, np.int64)), pa.array(np.asarray(n, np.int64)),
                 pa.array(np.asarray(y, np.int64))], ["kind", "id", "x", "n", "y"])

        def summed():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            seen.clear()
            common = counts >= COMMON
            yield rows(1, values[common].view(np.int64), counts[common], counts[common])
            small = [s for s in held if len(s) <= LARGEST_SMALL]
            if small:
                sizes = np.array([len(s) for s in small])
                lengths = counts[np.searchsorted(values, np.concatenate(small))]
                yield rows(2, np.arange(LARGEST_SMALL + 1), np.bincount(sizes, minlength=LARGEST_SMALL + 1),
                           np.bincount(np.repeat(sizes, sizes), lengths, LARGEST_SMALL + 1))
            held.clear()

        total = 0
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), words)
            nodes = _nodes(sets)
            yield rows(0, nodes, [len(s) for s in sets], nodes, batch.column("id"))
            for node, s in zip(nodes.tolist(), sets):
                if len(s) and node not in seen:
                    seen.add(node)
                    held.append(s)
                    total += len(s)
            if total >= COUNTED:
                yield from summed()
                total = 0
        if held:
            yield from summed()

    return docs.mapInArrow(survey, "kind int, id long, x long, n long, y long")


def boundary(sizes: list[tuple[int, int, int, int]], share: int = SHARE) -> int:
    """Largest size of a small set, by cost: keys of all subsets against list entries and the pairs that they
    make. `sizes`: (size, sets, total list length in the windows that were counted, windows)."""
    best, lowest = 0, None
    for x in range(LARGEST_SMALL + 1):
        cost = 0.0
        for n, sets, lists, windows in sizes:
            if n and n <= x:
                cost += sets * sum(comb(n, c) for c in _levels(n, x, share))
            if n and n >= _needed(x + 1, share):
                cost += sets * (n - _needed(n, share) + 1) * (1 + windows * lists / max(1, sets * n))
        if lowest is None or cost < lowest:
            best, lowest = x, cost
    return best


def _shared(na: Column, nb: Column, share: int = SHARE) -> Column:
    """Keys of the inverted lists that linked sets of na and nb shingles have in common, at least.

    They have t shingles in common, and all but the last ceil(0.75 n) - 1 of a set are its keys. Sets are in
    the same order, so the first of the common shingles are keys on both sides.
    """
    t = F.ceil((na + nb) * share / (100 + share))
    return F.least(*[t - F.ceil(n * share / 100) + 1 for n in (na, nb)])


def _postings(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], x: int, words: int, share: int) -> DataFrame:
    """(h, node, n): keys under which linked sets meet. A set of up to x shingles gives the hash of each
    subset; a set that may link with one above x gives its first shingles, the rare before the common: two
    linked sets have one of these in common, and mostly many (see `_shared`). Copies within a task are given once."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def keys(s: np.ndarray) -> Iterator[np.ndarray]:
        n = len(s)
        if n <= x:
            for c in _levels(n, x, share):
                parts = np.array(list(combinations(mix(s, 3).tolist(), c)), np.uint64)
                yield mix(parts.sum(axis=1), 4 + c)
        if n >= _needed(x + 1, share):
            (known, often), order = shared.value, s
            if len(known):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                order = s[np.argsort(np.where(known[at] == s, often[at], 0), kind="stable")]
            yield order[:n - _needed(n, share) + 1]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), words)
            out: list[tuple[np.ndarray, int, int]] = []
            for node, s in zip(_nodes(sets).tolist(), sets):
                if len(s) and node not in seen:
                    seen.add(node)
                    out += [(k, node, len(s)) for k in keys(s)]
            if out:
                lengths = [len(k) for k, _, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for k, _, _ in out]).view(np.int64)),
                     pa.array(np.repeat([a for _, a, _ in out], lengths)),
                     pa.array(np.repeat([n for _, _, n in out], lengths).astype(np.int32))], ["h", "node", "n"])

    return docs.mapInArrow(post, "h long, node long, n int")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, node, n) in order: those of keys with at least two nodes, and the first node of each as
    its hub. Goes through lists of any length without holding them."""
    last = None  # the row before, with its hub
    for batch in batches:
        h, node, n = (batch.column(c).to_numpy() for c in ("h", "node", "n"))
        if not len(h):
            continue
        if last:
            h, node, n = np.append(last[0], h), np.append(last[1], node), np.append(last[2], n)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (node[1:] == node[:-1])
        start = np.append(True, h[1:] != h[:-1])
        begin = np.maximum.accumulate(np.where(start, np.arange(len(h)), 0))
        hub, size = node[begin], n[begin]
        if last:
            first_run = int(np.argmax(start[1:])) + 1 if start[1:].any() else len(h)
            hub[:first_run], size[:first_run] = last[3], last[4]
        out = (node != hub) & ~again
        first = np.zeros(len(h), bool)  # hubs whose list goes on with another node
        first[:-1] = (node[:-1] == hub[:-1]) & (h[1:] == h[:-1]) & (node[1:] != hub[1:])
        out |= first
        if last:
            out[0] = first[0]
        yield pa.RecordBatch.from_arrays([pa.array(a[out]) for a in (h, node, n, hub, size)],
                                         ["h", "node", "n", "hub", "hub_n"])
        last = (h[-1], node[-1], n[-1], hub[-1], size[-1])


def _blobs(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the wanted (id, node)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = shingle_sets(batch.column("text"), words)
            own = _nodes(sets) == batch.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").filter(pa.array(own)),
                 pa.array([s.tobytes() for s, o in zip(sets, own) if o], pa.binary())], ["node", "shingles"])

    return docs.join(wanted, "id").mapInArrow(build, "node long, shingles binary")


def _verify(pairs: DataFrame, blobs: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, with the sizes of intersection and union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                merged = np.concatenate((s, t))
                merged.sort(kind="stable")
                both.append(int((merged[1:] == merged[:-1]).sum()))
            same = np.array(both, np.int64)
            total = (np.array([len(x.as_buffer()) // 8 for x in batch.column("x")], np.int64)
                     + np.array([len(x.as_buffer()) // 8 for x in batch.column("y")], np.int64) - same)
            keep = pa.array(100 * same >= share * total)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             ["a", "b"])

    one = blobs.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = blobs.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(compare, "a long, b long")


def _alike(na: Column, nb: Column, share: int) -> Column:
    return (na * 100 >= nb * share) & (nb * 100 >= na * share)


def _stars(matched: DataFrame, x: int, share: int) -> DataFrame:
    """One pair (a, b) for each node that may link with the hub of some of its lists; the hub with which it
    shares most keys. The hub of a list is the node whose keys are shared most: among the copies of a
    document that is the one they were made from, rather than another copy."""
    length = matched.groupBy("h").agg(F.count("*").alias("length"))
    weight = matched.join(length, "h").groupBy("node").agg(F.sum("length").alias("weight"))
    rows = matched.join(weight, "node")
    hubs = rows.groupBy("h").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    near = rows.join(hubs, "h").select("node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    least = F.when(F.greatest("n", "hub_n") <= x, 1).otherwise(_shared(F.col("n"), F.col("hub_n"), share))
    return (near.filter((F.col("node") != F.col("hub")) & _alike(F.col("n"), F.col("hub_n"), share))
            .groupBy("node", "n", "hub", "hub_n").agg(F.count("*").alias("c")).filter(F.col("c") >= least)
            .groupBy("node").agg(F.max(F.struct("c", "hub")).alias("best"))
            .select(F.col("node").alias("a"), F.col("best.hub").alias("b")))


def _cross(matched: DataFrame, comp: DataFrame, x: int, share: int) -> DataFrame:
    """Pairs (a, b) that share as many keys as linked sets of their sizes do, and aren't connected yet.

    Only keys that several components have count. Two nodes that must share t of their k keys have one of the
    first k - t + 1 in common, keys of short lists first; so a pair meets under few keys, and never when
    either node has fewer than t. The keys of a pair that has met are then counted.
    """
    rows = matched.join(comp, "node", "left").select("h", "node", "n", F.coalesce("comp", "node").alias("comp"))
    mixed = (rows.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"))
             .filter("low <> high").select("h", "size"))
    whole = Window.partitionBy("node")
    rows = materialize(rows.join(mixed, "h").select(
        "h", "node", "n", "comp", F.count("*").over(whole).alias("k"),
        F.row_number().over(whole.orderBy("size", "h")).alias("at")), "mixed")
    a, b = (rows.select("h", F.col("node").alias(side), *[F.col(c).alias(c + side) for c in ("n", "comp", "k", "at")])
            for side in "ab")
    least = F.when(F.greatest("na", "nb") <= x, 1).otherwise(_shared(F.col("na"), F.col("nb"), share))
    met = a.join(b, "h").filter(
        (F.col("a") < F.col("b")) & (F.col("compa") != F.col("compb")) & _alike(F.col("na"), F.col("nb"), share)
        & (F.col("ata") <= F.col("ka") - least + 1) & (F.col("atb") <= F.col("kb") - least + 1))
    met = materialize(met.select("a", "b", "na", "nb").distinct(), "met")
    keys = materialize(rows.groupBy("node").agg(F.collect_list("h").alias("keys")), "keys")
    one, two = (keys.select(F.col("node").alias(side), F.col("keys").alias("k" + side)) for side in "ab")
    return met.join(one, "a").join(two, "b").filter(F.size(F.array_intersect("ka", "kb")) >= least).select("a", "b")


def join(docs: DataFrame, words: int = WORDS, share: int = SHARE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, component_id): each document with the class of equal sets it is in and the
    component that the links make. Two documents link when 100 * intersection >= share * union.

    The join is exact. Documents with equal sets are one node. Sets of up to x shingles meet under their
    subsets of fixed size, larger ones in inverted lists of rare shingles; x is chosen by cost. Each list
    first gives a link from every node to one hub, so that a group of many near copies is connected without
    making its pairs; then all pairs that share a key but not a component are verified, so no link is lost.

    Text without words, or null: no shingles, linked with nothing, its own component. Rows with a null id
    link with nothing and have no component. Rows with the same id are compared each by its text.
    Other columns are not used.
    """
    rows = pick(docs, id=id_col, text=text_col)
    survey = materialize(_survey(rows, words), "survey")
    sets = survey.filter("kind = 0").select("id", F.col("n").alias("n_shingles"), F.col("x").alias("node"))
    common = (survey.filter("kind = 1").groupBy("x").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "x").limit(TOLD).toArrow())
    known = common.column("x").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    often = np.minimum(common.column("n").to_numpy(), 1 << 30).astype(np.int32)
    common = known[order], often[order]
    windows = max(1, survey.filter("kind = 2 and x = 0").count())
    sizes = [(r["x"], r["n"], r["y"], windows) for r in
             survey.filter("kind = 2").groupBy("x").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()]
    x = boundary(sizes, share)

    own = rows.filter(F.col("id").isNotNull())
    postings = _postings(own.select("text"), common, x, words, share)
    matched = materialize(postings.repartition("h").sortWithinPartitions("h", "node").mapInArrow(
        runs, "h long, node long, n int, hub long, hub_n int").select("h", "node", "n"), "matched")

    first = sets.filter("id is not null").groupBy("node").agg(F.min("id").alias("id"))

    def wanted(pairs):
        return first.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node")

    stars = _stars(matched, x, share)
    stars = materialize(stars, "stars")
    blobs = materialize(_blobs(own, wanted(stars), words), "sets")
    links = materialize(_verify(stars, blobs, share), "links")
    crossing = materialize(_cross(matched, components(links), x, share), "crossing")
    missing = materialize(wanted(crossing).join(blobs.select("node"), "node", "left_anti"), "wanted")
    if not missing.isEmpty():
        blobs = blobs.unionByName(materialize(_blobs(own, missing, words), "sets"))
    comp = components(links.union(_verify(crossing, blobs, share)))
    found = sets.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = found.filter("n_shingles > 0").groupBy("comp").agg(F.min("id").alias("least"))
    return found.join(least, "comp", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", "node", F.when(F.col("id").isNull(), None).otherwise(
            F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("least"))).alias("component_id"))


def drop_near_copies(docs: DataFrame, words: int = WORDS, share: int = SHARE, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, that have the smallest id of their component (see `join`). Texts
    without words, and rows with a null id, stay. Of rows with the same id, one of each text may stay."""
    found = materialize(join(docs, words, share, id_col, text_col), "components")
    keep = found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    ident = F.col(f"`{id_col}`")
    kept = docs.join(keep, ident == F.col("_kept"), "left_semi")
    total, different = found.filter("doc_id is not null").agg(F.count("*"), F.count_distinct("doc_id")).first()
    if total > different:
        kept = kept.dropDuplicates([id_col, text_col])
    return kept.unionByName(docs.filter(ident.isNull()))

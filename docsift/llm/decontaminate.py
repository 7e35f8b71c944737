"""Benchmark decontamination: parts of texts that are within an edit distance of an item."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import chunks, pick, small_batches

# Largest edit distance, in hundredths of the item's length.
DISTANCE = 25
# Grams of an item that lead to it, by its length: the letters at the places marked 1. A passage is looked at
# where `share` of the item's length in grams (one at least) stands at about the same distance from its begin.
# The gap lets grams meet across a changed letter, so also where every fifth letter is changed.
# Below 32 letters the grams are short enough that one is unchanged in every passage within 25 %.
GRAMS = [(32, "111", 0.0), (64, "1111", 0.0), (96, "1110111", 0.05), (1 << 62, "11110111", 0.05)]
# Grams that are held at a time, and texts that are compared with their items at a time.
HITS, LANES = 1 << 21, 2048
# Neighbouring bands that are compared as one part.
RUN = 4
# Work of a step over no parts at all, in words of parts: what short and long items cost apart is weighed with it.
STEP = 3000
# Words of 64 bits up to which items are compared side by side; longer ones are compared one by one.
SIDE_BY_SIDE = 16
# Bytes of benchmark text that are told to the tasks at once; a larger benchmark is searched in blocks.
BLOCK = 2 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _grams(codes: np.ndarray, shape: str, bits: int) -> np.ndarray:
    """A slot of 2^bits for the letters at each place that `shape` marks."""
    n = max(0, len(codes) - len(shape) + 1)
    out = np.zeros(n, np.uint64)
    for i in (i for i, mark in enumerate(shape) if mark == "1"):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[i:i + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return (out >> np.uint64(64 - bits)).astype(np.int64)


def distance_within(item: str, text: str, most: int) -> tuple[int, int]:
    """Smallest edit distance of `item` to any part of `text`, and where that part ends; the distance is
    `most` + 1 if there is none within `most`. Bit-parallel over the item (Myers 1999)."""
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    size = len(item)
    full, top = (1 << size) - 1, 1 << size - 1
    up, down, score, best, end = full, 0, size, most + 1, 0
    for j, c in enumerate(text, 1):
        same = places.get(c, 0)
        x = (((same & up) + up) ^ up) | same | down
        plus, minus = (down | ~(x | up)) & full, up & x
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        x = same | down
        up, down = (minus | ~(x | plus)) & full, plus & x
        if score < best:
            best, end = score, j
    return best, end


@dataclass
class Seeds:
    """Grams of items in the order of their slots; grams that share one by chance only lead to more parts."""

    shape: str
    bits: int
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray


class Searcher:
    """The items with their grams."""

    def __init__(self, items: list[tuple[int, str]], distance: int = DISTANCE):
        self.items = [(i, normal(t)) for i, t in items if i is not None and t and normal(t)]
        self.points = [_points(t) for _, t in self.items]
        self.chars = np.array([len(p) for p in self.points], np.int64)
        self.most = self.chars * distance // 100
        # a passage drifts from its item by at most as many letters as it has edits
        self.band = self.most + 1
        self.need = np.ones(len(self.items), np.int64)
        self.seeds: list[Seeds] = []
        shapes: dict[str, list[int]] = {}
        for k, n in enumerate(self.chars.tolist()):
            shape, share = next(g[1:] for g in GRAMS if n < g[0])
            self.need[k] = max(1, int(share * n))
            if n < GRAMS[0][0]:
                # of one part more than there may be edits, one is unchanged
                shape = shape[:max(1, n // (int(self.most[k]) + 1))]
            shapes.setdefault(shape, []).append(k)
        for shape, members in shapes.items():
            bits = max(10, int(8 * self.chars[members].sum()).bit_length())
            parts = [_grams(self.points[k], shape, bits) for k in members]
            counts = [len(p) for p in parts]
            slots = np.concatenate(parts)
            order = np.argsort(slots, kind="stable")
            self.seeds.append(Seeds(
                shape, bits, np.searchsorted(slots[order], np.arange((1 << bits) + 1)).astype(np.uint32),
                np.repeat(members, counts)[order], np.concatenate([np.arange(c) for c in counts])[order]))

    def candidates(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, start, end) of the parts of texts that have enough grams of an item in a band of two
        drifts. Texts lie at `starts` to `ends` of `points`."""
        # texts are set so far apart that bands of two texts never touch
        gap = int(self.chars.max() + 3 * self.band.max())
        shift = (np.arange(len(starts)) + 1) * gap
        width = len(points) + (len(starts) + 2) * gap
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        for seeds in self.seeds:
            slots = _grams(points, seeds.shape, seeds.bits)
            number = seeds.first[1:][slots] - seeds.first[slots]
            at = np.flatnonzero(number)
            text = np.searchsorted(starts, at, "right") - 1
            inside = at + len(seeds.shape) <= ends[text]
            at, text = at[inside], text[inside]
            head = seeds.first[slots[at]].astype(np.int64)
            sums = np.append(0, np.cumsum(number[at], dtype=np.int64))
            begin = 0
            while begin < len(at):
                stop = max(begin + 1, int(np.searchsorted(sums, sums[begin] + HITS, "right")) - 1)
                number = np.diff(sums[begin:stop + 1])
                which = np.repeat(np.arange(begin, stop), number)
                hit = np.arange(len(which)) + np.repeat(head[begin:stop] - (sums[begin:stop] - sums[begin]), number)
                item = seeds.item[hit]
                drift = (at + shift[text])[which] - seeds.place[hit]
                counted.append(np.unique(item * width + drift // self.band[item], return_counts=True))
                begin = stop
        if not counted:
            return (np.zeros(0, np.int64),) * 4
        keys = np.concatenate([c[0] for c in counted])
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], np.concatenate([c[1] for c in counted])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, numbers = keys[first], np.add.reduceat(numbers, first)
        item = keys // width
        # what drifts by no more than one band lies in two neighbouring ones
        both = numbers.copy()
        both[:-1] += np.where(keys[1:] == keys[:-1] + 1, numbers[1:], 0)
        both[1:] = np.maximum(both[1:], np.where(keys[1:] == keys[:-1] + 1, both[:-1], 0))
        kept = both >= self.need[item]
        keys, item = keys[kept], item[kept]
        fresh = np.append(True, keys[1:] != keys[:-1] + 1)[:len(keys)]
        run = np.arange(len(keys)) - np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))
        head = np.flatnonzero(run % RUN == 0)
        last = np.append(head[1:], len(keys))[:len(head)] - 1
        item, low, high = item[head], keys[head] % width, keys[last] % width + 1
        low, high = low * self.band[item], high * self.band[item]
        # the text whose stretch, from its own gap on, holds the begin of the band
        reach = starts + shift
        text = np.searchsorted(reach + (ends - starts), low, "left")
        text = np.minimum(text, len(starts) - 1)
        start = np.maximum(low - shift[text] - self.most[item], starts[text])
        end = np.minimum(high - shift[text] + self.chars[item] + self.most[item], ends[text])
        return text, item, start, end

    def _groups(self, words: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of parts, ordered by the words of their items, that are best compared in one go: a part costs
        as many steps and words as the largest of its stretch, a stretch some work per step."""
        out: list[tuple[int, int, int]] = []  # begin, end, longest
        cuts = np.flatnonzero(np.append(True, words[1:] != words[:-1])[:len(words)])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(words)]):
            out.append((a, b, int(sizes[a:b].max())))
            while len(out) > 1:
                (i, j, m), (_, k, n) = out[-2:]
                apart = m * (STEP + int(words[j - 1]) * (j - i)) + n * (STEP + int(words[k - 1]) * (k - j))
                if apart < max(m, n) * (STEP + int(words[k - 1]) * (k - i)):
                    break
                out[-2:] = [(i, k, max(m, n))]
        return [g[:2] for g in out]

    def _side_by_side(self, points: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray):
        """`distance_within` for many parts of texts at a time. The longest come first, and parts that are through
        are left out of further steps."""
        longest = np.argsort(start - end, kind="stable")
        best, where = np.empty_like(item), np.empty_like(item)
        best[longest], where[longest] = self._descending(points, item[longest], start[longest], end[longest])
        return best, where

    def _descending(self, points: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray):
        own, local = np.unique(item, return_inverse=True)
        letters = np.unique(np.concatenate([self.points[k] for k in own]))
        words = int(self.chars[own].max() + 63) // 64
        # row 0 of the masks is for letters that an item doesn't have
        known = [np.unique(self.points[k], return_inverse=True) for k in own]
        index = np.zeros((len(own), len(letters) + 1), np.int32)
        masks = np.zeros((words, 1 + sum(len(u) for u, _ in known)), np.uint64)
        used = 1
        for i, (k, (mine, at)) in enumerate(zip(own, known)):
            place = np.arange(self.chars[k])
            index[i, np.searchsorted(letters, mine)] = np.arange(used, used + len(mine))
            np.bitwise_or.at(masks, (place // 64, used + at), np.uint64(1) << (place % 64).astype(np.uint64))
            used += len(mine)
        steps = int((end - start).max())
        place = start[:, None] + np.arange(steps)
        seen = points[np.minimum(place, len(points) - 1)]
        row = np.minimum(np.searchsorted(letters, seen), len(letters) - 1)
        row[(letters[row] != seen) | (place >= end[:, None])] = len(letters)
        row = index[local[:, None], row].T.copy()
        one, low = np.uint64(1), np.uint64(63)
        bit = ((self.chars[item] - 1) % 64).astype(np.uint64)
        top = (self.chars[item] - 1) // 64 * len(item) + np.arange(len(item))
        up, down = np.full((words, len(item)), ~np.uint64(0)), np.zeros((words, len(item)), np.uint64)
        plus, minus = np.zeros_like(up), np.zeros_like(up)
        score = self.chars[item].copy()
        best, where = self.most[item] + 1, np.zeros(len(item), np.int64)
        lanes = len(item)
        open_lanes = lanes - np.searchsorted((end - start)[::-1], np.arange(steps), "right")
        for j in range(steps):
            if open_lanes[j] < lanes * 7 // 8:
                lanes = int(open_lanes[j])
                up, down, plus, minus = (bits[:, :lanes].copy() for bits in (up, down, plus, minus))
                bit, score = bit[:lanes], score[:lanes]
                top = (self.chars[item[:lanes]] - 1) // 64 * lanes + np.arange(lanes)
            same = masks[:, row[j, :lanes]]
            total = same & up
            total += up
            carries = total < (same & up)
            for w in range(words - 1):
                total[w + 1] += carries[w]
                carries[w + 1] |= carries[w] & (total[w + 1] == 0)
            total ^= up
            total |= same
            total |= down
            np.bitwise_or(total, up, out=plus)
            np.invert(plus, out=plus)
            plus |= down
            np.bitwise_and(up, total, out=minus)
            score += ((plus.ravel()[top] >> bit) & one).view(np.int64)
            score -= ((minus.ravel()[top] >> bit) & one).view(np.int64)
            for bits in (plus, minus):
                out = bits[:-1] >> low
                bits <<= one
                bits[1:] |= out
            np.bitwise_or(same, down, out=total)
            np.bitwise_and(plus, total, out=down)
            np.bitwise_or(total, plus, out=up)
            np.invert(up, out=up)
            up |= minus
            less = np.flatnonzero(score < best[:lanes])
            if len(less):
                best[less], where[less] = score[less], j + 1
        return best, where

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, end) for each text and item that lies within the distance somewhere."""
        if not self.items or not any(texts):
            return []
        points = _points("".join(texts))
        ends = np.cumsum([len(t) for t in texts])
        starts = np.append(0, ends[:-1])
        text, item, start, end = self.candidates(points, starts, ends)
        words = (self.chars[item] + 63) // 64
        found: dict[tuple[int, int], tuple[int, int]] = {}

        def note(n, k, best, at):
            if best <= self.most[k] and ((n, k) not in found or (best, at) < found[n, k]):
                found[n, k] = (best, at)

        order = np.lexsort((end - start, words))
        side = int(np.searchsorted(words[order], SIDE_BY_SIDE, "right"))
        for begin, stop in self._groups(words[order[:side]], (end - start)[order[:side]]):
            while begin < stop:
                part = order[begin:min(stop, begin + LANES)]
                # of a few very long parts only so many as fit into memory
                part = part[:max(1, int(np.searchsorted(np.maximum.accumulate((end - start)[part]) * np.arange(1, len(part) + 1), HITS, "right")))]
                best, where = self._side_by_side(points, item[part], start[part], end[part])
                hit = best <= self.most[item[part]]
                for i, d, at in zip(part[hit].tolist(), best[hit].tolist(), where[hit].tolist()):
                    note(int(text[i]), int(item[i]), d, int(start[i] - starts[text[i]]) + at)
                begin += len(part)
        for i in order[side:].tolist():
            n, k, at = int(text[i]), int(item[i]), int(start[i] - starts[text[i]])
            best, where = distance_within(self.items[k][1], texts[n][at:int(end[i] - starts[n])], int(self.most[k]))
            note(n, k, best, at + where)
        return [(n, k, *v) for (n, k), v in sorted(found.items())]


def _blocks(items: DataFrame, id_col: str, text_col: str, distance: int) -> list[Searcher]:
    """The benchmark in blocks of bounded size, each with its grams."""
    rows = pick(items, item_id=id_col, text=text_col).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK) or 1
    for i in range(count):
        block = rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == i) if count > 1 else rows
        yield Searcher(sorted((r["item_id"], r["text"]) for r in block.collect() if r["item_id"] is not None
                              and r["text"]), distance)


def leaks(docs: DataFrame, items: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id",
          text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, item_chars, end): each document with each item that some part of it is
    within `distance` hundredths of the item's length of, in edits; its closest place, the first of equal ones.

    Texts are lower-cased and their white space made single spaces. A part of a text where enough grams of an
    item's letters stand in the item's order (see `GRAMS`) is compared with the item exactly. Words play no part, so
    an item is also found inside a longer word or in text without spaces. Unchanged passages are always found;
    one with so many edits that hardly a gram is left may be missed.

    Null or empty texts and items, and items with a null id, match nothing. Repeated documents are reported
    each, with null ids too; repeated items once. No items, or no documents: no rows. Other columns
    are not used.
    """
    found = [_search(pick(docs, doc_id=id_col, text=text_col), searcher)
             for searcher in _blocks(items, item_id, item_text, distance)]
    return reduce(DataFrame.unionAll, found)


def _search(docs: DataFrame, searcher: Searcher) -> DataFrame:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(searcher)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in chunks(batches):
            hits = own.search([normal(t or "") for t in batch.column("text").to_pylist()])
            ids = batch.column("doc_id").cast(pa.int64()).to_pylist()
            rows = [(ids[n], own.items[k][0], best, len(own.items[k][1]), end) for n, k, best, end in hits]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                ["doc_id", "item_id", "distance", "item_chars", "end"])

    return docs.mapInArrow(search, "doc_id long, item_id long, distance long, item_chars long, end long")


def drop_leaks(docs: DataFrame, items: DataFrame, distance: int = DISTANCE, text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, that hold no item of the benchmark (see `leaks`). Row by
    row: nothing is shuffled, and rows with null ids or texts stay."""
    for searcher in _blocks(items, item_id, item_text, distance):
        docs = _clean(docs, searcher, text_col)
    return docs


def _clean(docs: DataFrame, searcher: Searcher, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(searcher)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            keep = np.ones(batch.num_rows, bool)
            hits = shared.value.search([normal(t or "") for t in batch.column(text_col).to_pylist()])
            keep[[n for n, *_ in hits]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)

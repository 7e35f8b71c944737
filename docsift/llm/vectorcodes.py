"""Compression of vectors to short codes: a codebook per part of the vector, trained on all vectors by Lloyd
rounds that look at active entries only.

All is done in integers, so results are exact and do not depend on how the rows are dealt out. A round is
one pass over a table that holds, next to each vector, the assigned entry of every part and the exact
squared distance to it. Where that entry has stayed the same, the stored distance still holds and no entry
that stayed the same can have become better, so the part is compared with the moved entries only; where it has moved,
the part is compared with all entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import pick
from docsift.plans.skew import BROADCAST_BYTES, salted_join
from docsift.session import Scratch, materialize, stored_bytes

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Distances and components that a task computes at a time.
BLOCK = 1 << 20

# A row of the table between two rounds: a vector, or what a task adds up (`sums`, and no vector).
STATE = "vec_id long, label string, vec binary, codes binary, dist binary, error long, sums array<bigint>"


@dataclass
class Codes:
    """`rows`: vec_id, label (as text), codes and dist (one entry per part), error; `codebooks`: the final
    entries by part, (part, entry, position); `compared`: pairs of a part and an entry that were compared, by pass."""

    rows: DataFrame
    codebooks: np.ndarray
    compared: list[int]

    def sha256(self) -> str:
        """Digest of all entries' decimal components by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """True for a vector that holds neither null nor a non-finite number. An empty one is usable."""
    bad = [F.array_contains(F.coalesce(vector, F.array()), F.lit(float(x)).cast("double")) for x in ("nan", "inf", "-inf")]
    clean = F.size(F.array_compact(vector)) == F.size(vector)
    return vector.isNotNull() & clean & ~F.coalesce(bad[0] | bad[1] | bad[2], F.lit(True))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each part; the lowest of equally near ones."""
    at = np.empty(len(parts), np.int64)
    dist = np.empty(len(parts), np.int64)
    step = max(1, BLOCK // max(1, entries.size))
    for i in range(0, len(parts), step):
        gap = parts[i:i + step, None, :] - entries[None]
        d = np.einsum("nkw,nkw->nk", gap, gap)
        at[i:i + step] = d.argmin(1)
        dist[i:i + step] = d.min(1, initial=np.iinfo(np.int64).max)
    return at, dist


def reassign(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray,
             dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entries after those marked in `moved` have moved, from the nearest ones before that.

    Also returns how many pairs were compared.
    """
    at, dist = at.copy(), dist.copy()
    rescan = moved[at]
    active = np.flatnonzero(moved)
    at[rescan], dist[rescan] = nearest(parts[rescan], entries)
    still = np.flatnonzero(~rescan)
    if len(active) and len(still):
        best, near = nearest(parts[still], entries[active])
        best = active[best]
        better = (near < dist[still]) | ((near == dist[still]) & (best < at[still]))
        at[still[better]], dist[still[better]] = best[better], near[better]
    return at, dist, int(rescan.sum()) * len(entries) + len(still) * len(active)


def _pass(codebooks: np.ndarray, moved: np.ndarray | None, bound: int):
    """One pass over vectors (`moved` None: without codes as yet). Ends with a row of the task's sums: per part and
    entry the number of parts assigned to it and the sum of each component; the last item is the number of comparisons."""
    parts, entries, width = codebooks.shape
    names = [c.split()[0] for c in STATE.split(", ")]

    def vectors(batch: pa.RecordBatch) -> np.ndarray:
        if moved is not None:
            flat = np.frombuffer(b"".join(batch.column("vec").to_pylist()), "<i4").astype(np.int64)
        else:
            column = batch.column("vec")
            column = column.cast(pa.large_list(pa.float64()))
            sizes = np.diff(column.offsets.to_numpy())
            if len(sizes) and (sizes != parts * width).any():
                raise ValueError(f"vectors of {parts * width} components expected, found {sizes[sizes != parts * width][0]}")
            scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
            if len(scaled) and np.abs(scaled).max() > bound:
                raise OverflowError("squared distances of such components do not fit 64 bits")
            flat = scaled.astype(np.int64)
        return flat.reshape(batch.num_rows, parts, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        compared = 0
        step = max(1, BLOCK // max(1, parts * width))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                n = batch.num_rows
                x = vectors(batch)
                at, dist = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
                if moved is not None:
                    was = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts)
                    far = np.frombuffer(b"".join(batch.column("dist").to_pylist()), "<i8").reshape(n, parts)
                for p in range(parts):
                    part = np.ascontiguousarray(x[:, p])
                    if moved is None:
                        at[:, p], dist[:, p] = nearest(part, codebooks[p])
                        pairs = n * entries
                    else:
                        at[:, p], dist[:, p], pairs = reassign(
                            part, codebooks[p], moved[p], was[:, p].astype(np.int64), far[:, p])
                    compared += pairs
                    counts[p] += np.bincount(at[:, p], minlength=entries)
                    np.add.at(sums[p], at[:, p], part)
                codes, far = at.astype(np.uint8), dist.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").cast(pa.int64()), batch.column("label").cast(pa.string()),
                     pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary()),
                     pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array([d.tobytes() for d in far], pa.binary()), pa.array(dist.sum(1)),
                     pa.nulls(n, pa.list_(pa.int64()))], names)
        total = np.concatenate([counts.ravel(), sums.ravel(), [compared]])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), *[pa.nulls(1, pa.binary()) for _ in range(3)],
             pa.nulls(1, pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names)

    return run


def _added_up(state: DataFrame, size: int) -> list[int]:
    """The sums of all tasks: as many numbers as a set of codebooks has, whatever the number of rows and tasks."""
    rows = (state.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("i", "x"))
            .groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
    total = [0] * size
    for r in rows:
        total[r["i"]] = int(r["x"])
    return total


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes | None:
    """Codes of all usable vectors, or None if there are none.

    Vectors that are null or hold a null or non-finite component are dropped. A component x becomes
    floor(4096 x); a vector is cut into `parts` equal parts. The codebook of a part starts with that part
    of the vectors with the `entries` smallest ids (of equal ids the smaller vector first, null ids last; fewer
    vectors give fewer entries). A round assigns each part to the nearest entry (the lower index of equally near
    ones) and then moves each entry to the floor of the mean of its parts; one without parts stays. After the
    last round the parts are assigned once more. Rows that occur several times count as often. The vectors
    must be of one length, a multiple of `parts`, and their distances fit 64 bits; else an error says so.

    Only codebooks and their sums pass the driver. A round writes its table to the shared folder and then
    drops the one before it, so a lost executor repeats its own tasks and two tables exist at a time.
    """
    rows = pick(vectors, vec_id=id_col, label=label_col, vec=vector_col)
    kept = rows.filter(usable(F.col("vec"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("vec").cast("array<double>").alias("vec"))
    seeds = kept.select("vec_id", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    if not seeds:
        return None
    size = len(seeds[0]["vec"])
    if size % parts or any(len(s["vec"]) != size for s in seeds):
        raise ValueError(f"vectors of one length that is a multiple of {parts} expected")
    # 2 x the bound, squared, over all components fits 63 bits
    bound = int((2 ** 62 / max(1, size)) ** 0.5 / 2)
    start = np.floor(np.array([s["vec"] for s in seeds], np.float64).reshape(len(seeds), size) * SCALE)
    if np.abs(start).max(initial=0) > bound:
        raise OverflowError("squared distances of such components do not fit 64 bits")
    books = np.ascontiguousarray(start.astype(np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2))
    cells = books.shape[0] * books.shape[1]
    scratch = Scratch(vectors.sparkSession, "codes")
    moved, state, compared = None, kept, []
    for n in range(rounds + 1):
        after = scratch.write(state.mapInArrow(_pass(books, moved, bound), STATE), f"pass-{n}")
        if n:
            scratch.drop(f"pass-{n - 1}")
        state = after.filter(F.col("sums").isNull()).drop("sums")
        total = _added_up(after, cells + books.size + 1)
        compared.append(total[-1])
        if n < rounds:
            counts = np.array(total[:cells], object).reshape(books.shape[:2])
            sums = np.array(total[cells:-1], object).reshape(books.shape)
            means = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books).astype(np.int64)
            moved = (means != books).any(2)
            books = means
    return Codes(state.drop("vec"), books, compared)


def digests(vectors: DataFrame) -> DataFrame:
    """Per kept vector: code (two hex digits per part), error, the error of all vectors of its label (null labels
    together), and the digest of the codebooks. No usable vector: no row."""
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    codes = compress(vectors)
    if codes is None:
        return vectors.sparkSession.createDataFrame([], out)
    rows = codes.rows.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error",
                             F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label"))
    labels = materialize(rows.groupBy("none", "label").agg(F.sum("error").alias("label_error")), "labels")
    if stored_bytes(labels) <= BROADCAST_BYTES:
        told = rows.join(F.broadcast(labels), ["none", "label"])
    else:
        told = salted_join(rows, labels, ["none", "label"], "vec_id", "label", right_unique=True)
    return told.select("vec_id", "code", "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


def rounds_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rows of `digests` over a table `embeddings`, in SQL that compares every part with every entry."""
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 parts AS MATERIALIZED (SELECT n, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x
  FROM kept, range({parts}) AS r(p)),
 book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN (SELECT n, row_number() OVER (
  ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept QUALIFY e < {entries}) USING (n))"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT n, p, min(struct_pack(
  d := list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))), e := e)) AS best
  FROM parts JOIN book{r} USING (p) GROUP BY n, p)""")
        if r < rounds:
            steps.append(f"""sum{r} AS (SELECT p, best.e AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS m
  FROM parts JOIN near{r} USING (n, p), unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL),
 mean{r} AS (SELECT p, e, list((s - ((s % m) + m) % m) // m ORDER BY i) AS c FROM sum{r} GROUP BY p, e),
 book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{r}.c, book{r}.c) AS c
  FROM book{r} LEFT JOIN mean{r} USING (p, e))""")
    return f"""WITH {", ".join(steps)},
 coded AS (SELECT n, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY n),
 books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
 SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
 FROM kept JOIN coded USING (n), books"""

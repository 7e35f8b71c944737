"""A uniform shuffle into shards of exact sizes; DataFrame functions only.

The rows of each partition are counted, and the matrix of how many rows go from which partition to which
shard is drawn as a whole from the law that a uniform shuffle of all rows would give it (multivariate
hypergeometric). Each partition permutes its rows by itself and hands them out by its line of the matrix;
each shard permutes what it got.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.texts import materialize
from docsift.session import stored_bytes

SHARDS = 16
SEED = 20
# Partitions that one node of the tree of draws divides its rows among.
FANOUT = 32
# Rows of a shard that are numbered together, on average.
BLOCK_ROWS = 1 << 18
# The matrix is told to all tasks up to so many bytes of its files; beyond, it is joined by a shuffle.
BROADCAST_BYTES = 16 * 1024 * 1024
# Outcomes further than this from the mean have a probability below 1e-20 and are not looked at.
SPREAD_SD, SPREAD_LEAST = 10, 20

_LONGS = "array<bigint>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, as the variable of a lambda."""
    return F.transform(F.array(value), use)[0]


def _uniform(*keys: Column | int) -> Column:
    """A number in [0, 1) that depends on the keys only."""
    bits = F.shiftrightunsigned(F.xxhash64(*[F.lit(k) if isinstance(k, int) else k for k in keys]), 11)
    return bits.cast("double") * (2.0 ** -53)


def hypergeometric(u: Column, population: Column, marked: Column, drawn: Column) -> Column:
    """How many of `drawn` items out of `population` are among the `marked` ones, by inversion of the
    uniform number `u`. Neighbouring probabilities have a rational ratio, so no logarithm and no
    factorial is needed, and the result always is a possible one."""
    n, k, d = (c.cast("double") for c in (population, marked, drawn))
    mean = F.when(population > 0, d * k / n).otherwise(F.lit(0.0))
    deviation = F.when(population > 1, F.sqrt(F.greatest(F.lit(0.0), mean * (1 - k / n) * (n - d) / (n - 1)))
                       ).otherwise(F.lit(0.0))
    reach = F.ceil(deviation * SPREAD_SD) + SPREAD_LEAST
    window = F.struct(
        F.greatest(F.lit(0).cast("long"), drawn + marked - population, F.floor(mean) - reach).alias("lo"),
        F.least(marked, drawn, F.floor(mean) + reach).alias("hi"))

    def ratio(i: Column) -> Column:
        return (k - i) * (d - i) / ((i + 1) * (n - k - d + i + 1))

    def from_window(w: Column) -> Column:
        outcomes = F.sequence(w["lo"], w["hi"])
        total = F.aggregate(
            outcomes, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
            lambda a, i: F.struct((a["w"] * ratio(i)).alias("w"), (a["sum"] + a["w"]).alias("sum")),
            lambda a: a["sum"])
        return _let(u * total, lambda target: F.aggregate(
            outcomes, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), w["lo"].alias("x")),
            lambda a, i: F.struct((a["w"] * ratio(i)).alias("w"), (a["sum"] + a["w"]).alias("sum"),
                                  F.when(a["sum"] + a["w"] <= target, F.least(a["x"] + 1, w["hi"]))
                                  .otherwise(a["x"]).alias("x")),
            lambda a: a["x"]))

    return _let(window, from_window)


def _line(rest: Column, rows: Column, shards: int, *keys: Column | int) -> Column:
    """One line of the matrix: `rows` rows drawn from the `rest` that the shards still take."""
    def step(a: Column, j: Column) -> Column:
        u = _uniform(*keys, j)
        return _let(hypergeometric(u, a["left"], F.get(rest, j), a["rows"]), lambda x: F.struct(
            (a["left"] - F.get(rest, j)).alias("left"), (a["rows"] - x).alias("rows"),
            F.concat(a["line"], F.array(x)).alias("line")))

    total = F.aggregate(rest, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(total.alias("left"), rows.alias("rows"), F.array().cast(_LONGS).alias("line"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step, lambda a: a["line"])


def communication_matrix(sizes: DataFrame, capacities: list[int], seed: int = SEED) -> DataFrame:
    """(part, line): for each partition how many of its rows go to each shard.

    `sizes` is (part, n); `capacities` adds up to all rows. The draw goes down a tree over the partition
    numbers, so its depth is the logarithm of their number and all nodes of a level are drawn in parallel:
    a node divides what the shards take from it among its children, one after the other.
    """
    spark = sizes.sparkSession
    largest = sizes.agg(F.max("part")).first()[0]
    depth = 1
    while FANOUT ** depth <= (largest or 0):
        depth += 1
    nodes = spark.range(1).select(F.col("id").alias("node"), F.array(*[F.lit(c).cast("long") for c in capacities])
                                  .alias("line"))
    for level in range(depth):
        below = FANOUT ** (depth - level - 1)
        child = F.floor(F.col("part") / below)
        children = (sizes.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
                    .groupBy(F.floor(F.col("child") / FANOUT).alias("node"))
                    .agg(F.map_from_entries(F.collect_list(F.struct(F.col("child") % FANOUT, "n"))).alias("rows")))

        def step(a: Column, c: Column) -> Column:
            rows = F.coalesce(F.element_at("rows", c), F.lit(0).cast("long"))
            drawn = _line(a["rest"], rows, len(capacities), seed, level, F.col("node"), c)
            return _let(drawn, lambda line: F.struct(
                F.zip_with(a["rest"], line, lambda x, y: x - y).alias("rest"),
                F.concat(a["lines"], F.array(line)).alias("lines")))

        lines = F.aggregate(
            F.sequence(F.lit(0).cast("long"), F.lit(FANOUT - 1).cast("long")),
            F.struct(F.col("line").alias("rest"), F.array().cast(f"array<{_LONGS}>").alias("lines")),
            step, lambda a: a["lines"])
        nodes = (nodes.join(children, "node").select("node", F.posexplode(lines).alias("c", "line"))
                 .select((F.col("node") * FANOUT + F.col("c")).alias("node"), "line"))
    return nodes.select(F.col("node").cast("long").alias("part"), "line").join(sizes.select("part"), "part", "left_semi")


def _numbered(docs: DataFrame, seed: int) -> DataFrame:
    """(doc, part, rank): each row as a struct, its partition, and its place after a local permutation.

    Sorted by hashes of their contents first, the rows of a partition have places that do not depend on the order
    in which they arrived (equal rows may be exchanged); the hash of the place then permutes them, equal rows
    included. Neither sort moves a row to another partition.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    contents = [F.col(f"`{c}`") for c in docs.columns if not any(t in kinds[c] for t in ("map<", "variant"))]
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    settled = (docs.select(F.struct("*").alias("doc"), F.xxhash64(F.lit(seed), *contents).alias("one"),
                           F.xxhash64(F.lit(seed + 1), *contents).alias("two"))
               .sortWithinPartitions("one", "two").select("doc", part.alias("part"), place.alias("rank")))
    return (settled.withColumn("key", F.xxhash64(F.lit(seed + 2), "part", "rank"))
            .sortWithinPartitions("key", "rank").select("doc", "part", place.alias("rank")))


def deal(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All rows with `shard` and `slot`: a uniform random order of all rows, cut into shards whose
    numbers of rows differ by at most one, the first ones being the larger; slots count from 0 without a gap.

    The law is that of rows: texts have no say, so equal texts are dealt like any others, and a row with nulls
    is a row. Every column is kept, whatever its name; only a `shard` and `slot` of the input are replaced. An
    empty table stays empty. Numbered rows are written to the shared folder once, so that all later steps
    agree on them even after a lost executor. The same rows in the same partitions are dealt alike by the same seed.

    The rows are shuffled once, by shard and block of a shard. A block is a slice of the hashes that
    permute the shard, so a shard of any size is put in order by many tasks.
    """
    docs = docs.drop("shard", "slot")
    rows = materialize(_numbered(docs, seed), "numbered")
    sizes = materialize(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    capacities = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = materialize(communication_matrix(sizes, capacities, seed), "matrix")
    if stored_bytes(matrix) <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)

    until = F.aggregate("line", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("shard")),
                        lambda a, x: F.struct((a["sum"] + x).alias("sum"),
                                              F.when(a["sum"] + x <= F.col("rank"), a["shard"] + 1)
                                              .otherwise(a["shard"]).alias("shard")), lambda a: a["shard"])
    blocks = max(1, -(-total // (shards * BLOCK_ROWS)))
    key = F.xxhash64(F.lit(seed + 3), "part", "rank")
    block = F.floor(F.shiftrightunsigned(key, 11).cast("double") * (2.0 ** -53) * blocks)
    sent = rows.join(matrix, "part").select("doc", "part", "rank", until.alias("shard"), key.alias("key"),
                                            block.alias("block"))
    # few narrow rows: where each block of a shard begins
    held = sent.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    begin = held.select("shard", "block", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("base"))
    order = Window.partitionBy("shard", "block").orderBy("key", "part", "rank")
    placed = sent.withColumn("at", F.row_number().over(order) - 1).join(begin, ["shard", "block"])
    return placed.select("doc.*", F.col("shard").cast("int").alias("shard"),
                         (F.col("base") + F.col("at")).cast("long").alias("slot"))


def write_shards(dealt: DataFrame, path: str) -> None:
    """One folder per shard, its rows in order of their slots within each file."""
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digests(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each document goes: doc_id, size (UTF-8 bytes and one; null text: 1), crc32 of the text
    (null: 0), the law, shard and slot. Only these columns are shuffled."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"))
    return deal(narrow, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                       F.lit(None).cast("int").alias("grown_shard"))

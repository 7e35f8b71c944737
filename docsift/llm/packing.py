"""Packing documents into sequences of fixed length: concatenate and cut."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.texts import chunks, materialize, pick

LENGTH = 2048
END = 1
# Partitions whose totals are summed together in the first step of the prefix sum.
GROUP = 1024
# Words whose ids a task remembers; a full memory is emptied.
MEMORY = 400_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long")


def default_vocabulary() -> str:
    """The byte-level BPE of 50,257 ids among the installed public vocabularies."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit bytes.

    `vocabulary` is the tokenizers file. The rank file of the same vocabulary beside it, if there is one,
    is used through tiktoken, which gives the same ids in a quarter of the time. No token reaches over a
    single space, so the ids of a word are remembered. With `plain`, strings of special tokens in
    a text are ordinary text.
    """

    def __init__(self, vocabulary: str, plain: bool = False):
        import os

        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(vocabulary)
        self.full.encode_special_tokens = plain
        self.marks = [] if plain else [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.size = self.full.get_vocab_size()
        ranks, self.fast, self.words = os.path.splitext(vocabulary)[0] + ".tiktoken", None, {}
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                          special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(m in text for m in self.marks):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text:
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        head, *rest = text.split(" ")
        known, out = self.words, [np.array(self.fast.encode_ordinary(head), "<u4").tobytes()]
        if len(known) > MEMORY:
            known.clear()
        for word in rest:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = np.array(self.fast.encode_ordinary(" " + word), "<u4").tobytes()
            out.append(ids)
        return b"".join(out)


    def decode(self, ids: bytes) -> str:
        """The text of ids that this encoder made."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.fast is None:
            return self.full.decode(numbers, skip_special_tokens=False)
        return self.fast.decode_bytes(numbers).decode("utf-8")


def tokenize(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """(doc_id, ids, n, part, before): ids with the closing id, and the ids before them in the same
    partition of this pass."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, part, before = Encoder(vocabulary), TaskContext.get().partitionId(), 0
        tail = np.array([end], "<u4").tobytes()
        for batch in chunks(batches):
            ids = [encoder(t or "") + tail for t in batch.column("text").to_pylist()]
            counts = np.array([len(i) // 4 for i in ids], np.int64)
            ends = before + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(counts),
                 pa.array(np.full(len(ids), part, np.int64)), pa.array(ends - counts)],
                ["doc_id", "ids", "n", "part", "before"])
            before = int(ends[-1])

    return docs.mapInArrow(encode, "doc_id long, ids binary, n long, part long, before long")


def partition_offsets(tokens: DataFrame) -> DataFrame:
    """(part, base): ids in all earlier partitions. Totals are one row per partition of the first pass;
    they are summed within groups of partitions and then over the groups."""
    totals = (tokens.groupBy("part").agg(F.sum("n").alias("n"))
              .withColumn("grp", F.floor(F.col("part") / GROUP)))
    inner = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = (totals.groupBy("grp").agg(F.sum("n").alias("n"))
              .select("grp", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("head")))
    return (totals.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(groups, "grp")
            .select("part", (F.col("head") + F.col("inside")).alias("base")))


def _cut(length: int, total: int):
    """Pieces of placed documents. The last sequence may be short: it is padded to `length`, unless
    it already is a power of two long."""
    last, rest = divmod(total, length)
    short = rest if rest & (rest - 1) == 0 else length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
            for doc, ids, n, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "n", "at"))):
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(length - offset, n - start)
                    for k, v in zip(rows, (doc, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]), n,
                                           sequence, offset)):
                        rows[k].append(v)
                    start += size
            rows["sequence_length"] = [short if s == last else length for s in rows["sequence_id"]]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in rows.values()], list(rows))

    return cut


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Put all documents behind one another and cut the stream every `length` ids.

    First pass: encode each text (with the closing id `end`) and write the ids with their place in their
    partition. The partitions' totals then give every document its place in the whole stream, and the second
    pass cuts at multiples of `length`; a document that crosses a cut gets a piece in either sequence.
    All sequences but the last are full. No shuffle moves ids; the only joined table has one row
    per partition of the first pass (16 bytes each; above four million rows it isn't broadcast).

    Null or empty text: only the closing id. Null ids stay null, repeated rows are packed each.
    No documents: no pieces. Other columns are not used.
    """
    tokens = materialize(tokenize(pick(docs, doc_id=id_col, text=text_col), vocabulary, end), "tokens")
    base = materialize(partition_offsets(tokens), "offsets")
    parts, total = base.count(), tokens.agg(F.sum("n")).first()[0] or 0
    if parts < 4_000_000:
        base = F.broadcast(base)
    placed = tokens.join(base, "part").select("doc_id", "ids", "n", (F.col("base") + F.col("before")).alias("at"))
    return placed.mapInArrow(_cut(length, total), PIECES)

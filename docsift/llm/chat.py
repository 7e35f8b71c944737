"""Chat formatting at the level of token ids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.packing import Encoder
from docsift.llm.texts import pick

# What the reserved ids look like in the formatted text: begin of a turn, end of its role, end of the turn.
OPEN, HEAD, CLOSE = "### ", ": ", "</turn>\n"
TRAINED = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")

TURNS = "conv_id long, turn long, start long, ids binary, loss_start long, loss_end long"


def escape(text: str, role: bool = False) -> str:
    """A backslash before each control string of the template, and before each backslash."""
    return (_ROLE_CONTROL if role else _CONTROL).sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> str:
    """The formatted text of a turn whose role and text are escaped."""
    return f"{OPEN}{role}{HEAD}{text}{CLOSE}"


def _encode(vocabulary: str):
    """Each turn by itself: role and text are encoded separately and the reserved ids put between them, so
    no token can reach over a border and no text can contain a reserved id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, plain=True)
        opened, head, close = (np.array([encoder.size + i], "<u4").tobytes() for i in range(3))
        for batch in batches:
            ids, before, inside = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                start = opened + encoder(escape(role or "", True)) + head
                content = encoder(escape(text or ""))
                ids.append(start + content + close)
                before.append(len(start) // 4)
                inside.append(len(content) // 4 if role == TRAINED else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id").cast(pa.int64()), batch.column("turn").cast(pa.int64()), batch.column("role"),
                 pa.array(ids, pa.binary()), pa.array(before, pa.int64()), pa.array(inside, pa.int64())],
                ["conv_id", "turn", "role", "ids", "before", "inside"])

    return encode


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix sums within each conversation, over rows in order. Only the sum is kept between batches."""
    last, total = ("none",), 0
    for batch in batches:
        convs = batch.column("conv_id").to_pylist()
        sizes = [len(i) // 4 for i in batch.column("ids").to_pylist()]
        starts = []
        for conv, size in zip(convs, sizes):
            if (conv,) != last:
                last, total = (conv,), 0
            starts.append(total)
            total += size
        starts = np.array(starts, np.int64)
        begin = starts + batch.column("before").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("turn"), pa.array(starts), batch.column("ids"), pa.array(begin),
             pa.array(begin + batch.column("inside").to_numpy())],
            ["conv_id", "turn", "start", "ids", "loss_start", "loss_end"])


def format_chats(turns: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted conversations, one row per turn: its ids, where they start in the conversation, and the
    part of the conversation under the loss mask (the content of assistant turns, without reserved ids).

    Reserved ids follow the vocabulary: begin of a turn, end of its role, end of the turn. Rows of a conversation
    lie together in one partition, ordered by turn, then role and ids; a long conversation is never held
    as a whole. Null role or text: empty. Null conversation ids are one conversation, null turns
    come first, repeated rows are turns of their own. Other columns are not used.
    """
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    encoded = rows.mapInArrow(_encode(vocabulary), "conv_id long, turn long, role string, ids binary, before long, "
                                                   "inside long")
    return (encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
            .mapInArrow(_place, TURNS))


def digests(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """Read formatted conversations back, row by row in the order in which they lie: number of turns,
    digest of roles and texts, length and digest of what the mask covers, length of the formatted text."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, plain=True)
        head = encoder.size + 1
        state = None

        def row():
            conv, turns, whole, chars, loss, size = state
            return [conv, turns, whole.hexdigest(), chars, loss.hexdigest(), size]

        for batch in batches:
            done = []
            for conv, start, ids, first, last in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "start", "ids", "loss_start", "loss_end"))):
                if state is None or state[0] != conv:
                    if state:
                        done.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                cut = int(np.flatnonzero(np.frombuffer(ids, "<u4") == head)[0])
                role, text = encoder.decode(ids[4:4 * cut]), encoder.decode(ids[4 * cut + 4:-4])
                state[1] += 1
                state[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                state[5] += len(render(role, text))
                if last > first:
                    learned = unescape(encoder.decode(ids[4 * (first - start):4 * (last - start)]))
                    state[3] += len(learned)
                    state[4].update(learned.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in done], pa.string() if "sha" in n else pa.int64())
                 for i, n in enumerate(names)], names)
        if state:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string() if "sha" in n else pa.int64()) for v, n in zip(row(), names)], names)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts hold the control strings."""
    probe = "\\### Assistant: </turn> ok"
    more = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(more)

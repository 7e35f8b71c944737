"""Repair of the structure of conversations: the cheapest edits after which the roles read as (s?(ua)+)?, that is an
optional system turn and then user and assistant in turn.

A Viterbi search goes over the rows of a conversation in order. Its state is what the last kept turn was; for each
state it keeps the cheapest edits that lead there (its survivor) as a path in a tree of back pointers. Nodes
count their references, so paths of dead survivors vanish, and as soon as all survivors share an ancestor, the edits
up to it are certain, are handed out and are forgotten. What is held is therefore the part on which survivors still differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.texts import pick

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
# A truncated row that is not deleted.
TRUNCATED = 5
SPACE = " \t\n\x0b\x0c\r"
END = (".", "!", "?")

# What the last kept turn was: none, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
NAME = {USER: "user", ASSISTANT: "assistant"}
# Where a turn with this initial leads from each state.
FOLLOWS = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT},
           "": {s: s for s in range(4)}}
# Where the only role that may follow leads: inserts and new roles are users or assistants.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}

EDITS = ("conv_id long, seq long, edit string, turn long, role string, text string, "
         "report struct<gaps: long, blank: long, duplicate: long, truncated: long, illegal: long, cost: long>")
# Bytes of text in a batch that is handed on.
BATCH = 1 << 20


# ---------------------------------------------------------------- one conversation

class Node:
    """An edit in the tree; its parent is the edit before it."""

    __slots__ = ("edit", "turn", "role", "text", "parent", "depth", "kids", "tips")

    def __init__(self, edit: str, turn: int | None, role: str, text: str, parent: Node | None):
        self.edit, self.turn, self.role, self.text, self.parent = edit, turn, role, text, parent
        self.depth = parent.depth + 1 if parent else 0
        self.kids: list[Node] = []
        self.tips = 0


def _less(x: tuple, y: tuple) -> bool:
    """Whether path x = (node, later edits) reads as less than y: from their last common node on, in full."""
    (a, late_a), (b, late_b) = x, y
    one, two = [], []
    while a is not b:
        if a.depth >= b.depth:
            one.append(a.edit)
            a = a.parent
        else:
            two.append(b.edit)
            b = b.parent
    return "".join(reversed(one)) + late_a < "".join(reversed(two)) + late_b


class Repair:
    """The search over one conversation: `row` for each row in order, then `finish`. Both return the edits that
    have become certain, as nodes. `held` is the number of edits that are not certain yet."""

    def __init__(self) -> None:
        self.root = Node("", None, "", "", None)
        self.root.tips = 1
        self.live: dict[int, tuple[int, Node]] = {NONE: (0, self.root)}
        self.held = 0

    def _paths(self) -> dict[int, tuple]:
        """By state the best (cost, node, inserts that follow it). Two inserts lead from a state to any other that inserts
        can reach; more only go round in a circle."""
        best: dict[int, tuple] = {s: (c, n, 0) for s, (c, n) in self.live.items()}
        for _ in range(2):
            for s, (cost, node, inserts) in list(best.items()):
                _offer(best, NEXT[s], (cost + COST[INSERT], node, inserts + 1))
        return best

    def _grow(self, path: tuple, state: int) -> Node:
        """The nodes of the inserts at the end of a path; `state` is where the inserts lead."""
        _, node, inserts = path
        states = [state] if inserts == 1 else [USER if state == ASSISTANT else ASSISTANT, state]
        for s in states[:inserts]:
            node = self._node(INSERT, None, NAME[s], "", node)
        return node

    def _node(self, edit: str, turn: int | None, role: str, text: str, parent: Node) -> Node:
        node = Node(edit, turn, role, text, parent)
        parent.kids.append(node)
        self.held += 1
        return node

    def _release(self, node: Node) -> None:
        node.tips -= 1
        while node is not self.root and not node.tips and not node.kids:
            node.parent.kids.remove(node)
            self.held -= 1
            node = node.parent

    def row(self, turn: int | None, role: str, text: str, must_go: bool, truncated: bool) -> list[Node]:
        found: dict[int, tuple] = {}
        more = TRUNCATED if truncated else 0
        keeps = {} if must_go else FOLLOWS.get(role[:1], {})
        for s, path in self._paths().items():
            cost = path[0]
            _offer(found, s, (cost + COST[DELETE], *path[1:], DELETE, s))
            if s in keeps:
                _offer(found, keeps[s], (cost + COST[KEEP] + more, *path[1:], KEEP, s))
            if not must_go:
                _offer(found, NEXT[s], (cost + COST[REROLE] + more, *path[1:], REROLE, s))
        before, self.live = self.live, {}
        for s, (cost, node, inserts, edit, came) in _possible(found).items():
            parent = self._grow((cost, node, inserts), came)
            new = self._node(edit, turn, NAME[s] if edit == REROLE else role, text, parent)
            new.tips = 1
            self.live[s] = (cost, new)
        for _, node in before.values():
            self._release(node)
        return self._certain()

    def _certain(self) -> list[Node]:
        out = []
        while not self.root.tips and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.held -= 1
            out.append(self.root)
        return out

    def finish(self) -> tuple[list[Node], int]:
        """The rest of the edits and the cost of all."""
        paths = self._paths()
        best: dict[int, tuple] = {}
        for s in ENDS:
            if s in paths:
                _offer(best, NONE, (*paths[s], "", s))
        cost, node, inserts, _, state = best[NONE]
        node = self._grow((cost, node, inserts), state)
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1], cost


def _offer(best: dict[int, tuple], state: int, path: tuple) -> None:
    """Keep the cheaper of two paths (cost, node, inserts after it, edit after those, state before that) to a state;
    of equally cheap ones the one whose edits read as less."""
    has = best.get(state)
    if has is None or path[0] < has[0]:
        best[state] = path
    elif path[0] == has[0]:
        late, late_has = (INSERT * p[2] + "".join(p[3:4]) for p in (path, has))
        if _less((path[1], late), (has[1], late_has)):
            best[state] = path


def _possible(found: dict[int, tuple]) -> dict[int, tuple]:
    """Without the survivors that cost so much that no end can make them best. What follows a state can follow
    another one after inserts; what follows `NONE` or `SYSTEM` can follow `ASSISTANT`, where only a system row
    that `NONE` would keep has to be deleted. Equal costs are left, since the order of the edits decides there."""
    cost = {s: p[0] for s, p in found.items()}
    insert, far = COST[INSERT], float("inf")
    user, assistant = cost.get(USER, far), cost.get(ASSISTANT, far)
    closed = min(assistant, user + insert)
    limit = {NONE: closed + COST[DELETE], SYSTEM: closed, ASSISTANT: user + insert,
             USER: min(cost.get(s, far) for s in (NONE, SYSTEM, ASSISTANT)) + insert}
    return {s: p for s, p in found.items() if p[0] <= limit[s]}


# ---------------------------------------------------------------- all conversations

@dataclass
class _Open:
    """The conversation that is being read."""

    conv: int | None
    search: Repair = field(default_factory=Repair)
    seq: int = 0
    last: tuple | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def add(self, turn: int | None, role: str, text: str, first: dict | None) -> list[Node]:
        """`first`: the first turn with this role and text, where it occurs more than once."""
        this = (turn, role, text)
        if turn is not None and (self.last is None or self.last[0] != turn):
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        stripped = text.rstrip(SPACE)
        blank = not stripped
        duplicate = not blank and first is not None and (first["turn"] != turn or this == self.last)
        truncated = not blank and not duplicate and not stripped.endswith(END)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.last = this
        return self.search.row(turn, role, text, blank or duplicate, truncated)

    def report(self, cost: int) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": cost}


_FIELDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.struct(
    [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])]
_NAMES = ["conv_id", "seq", "edit", "turn", "role", "text", "report"]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and turn; hands the edits out in batches of about `BATCH` bytes."""
    out: list[tuple] = []
    size = 0
    open_: _Open | None = None

    def take(nodes: list[Node]) -> None:
        nonlocal size
        for n in nodes:
            out.append((open_.conv, open_.seq, n.edit, n.turn, n.role, n.text, None))
            open_.seq += 1
            size += 100 + 2 * len(n.text)

    def close() -> None:
        nodes, cost = open_.search.finish()
        take(nodes)
        out.append((open_.conv, open_.seq, None, None, None, None, open_.report(cost)))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_FIELDS)], _NAMES)

    for rows in batches:
        columns: list[list[Any]] = [rows.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone", "first")]
        for conv, turn, role, text, gone, first in zip(*columns):
            if open_ is None or open_.conv != conv:
                if open_ is not None:
                    close()
                open_ = _Open(conv)
            if not gone:
                take(open_.add(turn, role, text, first))
            if size >= BATCH:
                yield batch()
                out, size = [], 0
    if open_ is not None:
        close()
    if out:
        yield batch()


def _with_first(rows: DataFrame) -> DataFrame:
    """Column `first`: the first turn (null turns come first) of this role and text in the conversation, for those
    that occur more than once; else null. Found by partial minima per digest, so that copies shrink to a row per task."""
    keyed = rows.withColumns({
        "k0": F.coalesce("conv_id", F.lit(0)), "k1": F.col("conv_id").isNull(),
        "k2": F.when(~F.col("gone"), F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))})
    keys = ["k0", "k1", "k2"]
    again = (keyed.filter("NOT gone").groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("turn"))
             .filter("n > 1").select(*keys, F.struct("turn").alias("first")))
    return keyed.join(again, keys, "left").drop(*keys)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", gone: Column | None = None) -> DataFrame:
    """The cheapest edits of each conversation in order: `edit` K (kept), R (given the role user or assistant), D (deleted)
    or I (inserted without text), with the turn, role and text that it leaves (of D: that it deletes). Of equally
    cheap edits those whose letters in order are ASCII-least. The last row of a conversation has no edit but a
    `report`: gaps between turns, rows by their first fault (blank, duplicate, truncated), adjacent roles that
    may not follow each other, cost. Blank and duplicate rows are always deleted.

    Rows are read by turn, null turns first, equal turns by role and text. Null roles and texts are one space, null ids
    one conversation. An empty role has no initial: keeping it changes nothing. Rows that occur twice are
    duplicates. Rows marked by `gone` are left out, but their conversation gets its report. Other columns are not
    used; an empty table stays empty.

    A conversation is read by one task as a stream from a sort that may spill, and its edits leave it as soon as they are
    certain; so its length and the length of its texts are not bounded by memory.
    """
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col) if gone is None else turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"), gone.alias("gone"))
    if gone is None:
        rows = rows.withColumn("gone", F.lit(False))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"),
                       F.when(~F.col("gone"), F.coalesce("text", F.lit(" "))).alias("text"), "gone")
    return (_with_first(rows).select("conv_id", "turn", "role", "text", "gone", "first").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_search, EDITS))


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq (increasing, with gaps where rows were deleted), turn (null: inserted), role, text."""
    return edits.filter(F.col("edit") != DELETE).select("conv_id", "seq", "turn", "role", "text")


def digests(edits: DataFrame, stored: bool = False) -> DataFrame:
    """A row per conversation: its report, all edits as a string, and the digest of the repaired `role:text` lines.

    Edits are read in the order in which `repair` leaves them; those of a table that was written and read
    back (`stored`) are put in order first.
    """
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", *counts, "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, begun = [], hashlib.sha256(), False
        for rows in batches:
            done = []
            for conv, edit, role, text, report in zip(*(rows.column(c).to_pylist() for c in (
                    "conv_id", "edit", "role", "text", "report"))):
                if report is not None:
                    done.append([conv, *[report[c] for c in counts], "".join(audit), digest.hexdigest()])
                    audit, digest, begun = [], hashlib.sha256(), False
                    continue
                audit.append(edit)
                if edit != DELETE:
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names)

    if stored:
        edits = edits.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return edits.mapInArrow(read, ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, kinds)))


# ---------------------------------------------------------------- the registered query

def damage(turns: DataFrame) -> DataFrame:
    """Conversations with faults: by the crc32 of `conv_id:turn` (nulls: one space) modulo 20 a row is 0 dropped (`gone`),
    1 emptied, 2 freed of `.!?`, 3 repeated, 4 given to the user. Null roles and texts become one space."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).cast("int")
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


def damaged_digests(turns: DataFrame) -> DataFrame:
    return digests(repair(damage(turns), gone=F.col("gone")))


def repair_sql() -> str:
    """The rows of `damaged_digests` over a table `conversations`: for each state the best (cost, edits, repaired lines) in
    full, row by row."""
    def best(*options: str) -> str:
        return f"list_aggregate(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL), 'min')"

    def step(state: str, edit: str, cost: str, line: str | None, when: str = "true") -> str:
        more = f"{state}.r" if line is None else f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || {line}"
        return (f"CASE WHEN {state} IS NOT NULL AND {when} THEN struct_pack(c := {state}.c + {cost}, "
                f"a := {state}.a || '{edit}', r := {more}) END")

    def insert(state: str, role: str) -> str:
        return step(state, INSERT, "5", f"'{role}:'")

    def follow(state: str, initial: str, role: str) -> list[str]:
        kept = step(state, KEEP, "late", "role || ':' || text", f"NOT must AND left(role, 1) = '{initial}'")
        if initial == "s":
            return [kept]
        return [kept, step(state, REROLE, "1 + late", f"'{role}:' || text", "NOT must")]

    def same(state: str) -> list[str]:
        return [step(state, DELETE, "2", None),
                step(state, KEEP, "late", "role || ':' || text", "NOT must AND role = ''")]

    once = (f"{{}}s0 AS t0, s1 AS t1, {best('s2', *[insert(s, 'user') for s in ('s0', 's1', 's3')])} AS t2, "
            f"{best('s3', insert('s2', 'assistant'))} AS t3")
    twice = (f"{{}}t0 AS k0, t1 AS k1, {best('t2', insert('t3', 'user'))} AS k2, "
             f"{best('t3', insert('t2', 'assistant'))} AS k3")
    moved = ", ".join(f"{best(*options)} AS s{n}" for n, options in enumerate((
        same("k0"), [*same("k1"), *follow("k0", "s", "")],
        [*same("k2"), *[o for k in ("k0", "k1", "k3") for o in follow(k, "u", "user")]],
        [*same("k3"), *follow("k2", "a", "assistant")])))
    white = r"[\x20\x09-\x0D]"
    return rf"""WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
 kinds AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(k) + 1), lambda i:
   CAST(ord(k[i]) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR z IN range(8)]),
   lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS kind FROM keyed),
 damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) WHERE kind <> 0),
 numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank FROM damaged),
 marked AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
  lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
 faults AS MATERIALIZED (SELECT *, blank OR duplicate AS must, NOT blank AND NOT duplicate
  AND NOT regexp_matches(text, '[.!?]{white}*\z') AS truncated,
  CASE WHEN NOT blank AND NOT duplicate AND NOT regexp_matches(text, '[.!?]{white}*\z') THEN 5 ELSE 0 END AS late FROM marked),
 walk AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS BIGINT), a := '', r := '') AS s0,
   CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s2,
   CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, r VARCHAR)) AS s3 FROM conversations
  UNION ALL SELECT conv_id, i, {moved} FROM (SELECT {twice.format("conv_id, i, must, late, role, text, ")}
   FROM (SELECT {once.format("walk.conv_id, walk.i + 1 AS i, must, late, role, text, ")}
    FROM walk JOIN faults ON walk.conv_id IS NOT DISTINCT FROM faults.conv_id AND faults.i = walk.i + 1))),
 ends AS (SELECT conv_id, {best("s0", "t3")} AS x FROM (SELECT conv_id, s0, t0, {best("t3", insert("t2", "assistant"))} AS t3
  FROM (SELECT {once.format("conv_id, s0, ")} FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1))),
 counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
  count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE before IS NOT NULL
   AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
 SELECT ends.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, x.c AS cost, x.a AS audit,
  sha256(x.r) AS repaired_sha256 FROM ends LEFT JOIN counts ON ends.conv_id IS NOT DISTINCT FROM counts.conv_id"""

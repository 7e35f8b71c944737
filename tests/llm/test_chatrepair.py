import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest

from docsift.llm import chatrepair as C

SCHEMA = "conv_id long, turn long, role string, text string, node string, edit string"
GOOD = re.compile(r"(s?(ua)+)?")


def by_search(rows):
    """(cost, audit, repaired) of all edit sequences with up to two inserts at a place; rows: (role, text, must, late)."""
    best = None
    names = {"u": "user", "a": "assistant"}
    options = []
    for role, text, must, late in rows:
        o = [("D", 2, None)]
        if not must:
            o.append(("K", 5 * late, (role, text)))
            o += [("R", 1 + 5 * late, (names[x], text)) for x in "ua"]
        options.append(o)
    inserts = ["", "u", "a", "ua", "au"]
    for edits in product(*options):
        for extra in product(inserts, repeat=len(rows) + 1):
            cost, audit, kept = 0, "", []
            for i in range(len(rows) + 1):
                cost += 5 * len(extra[i])
                audit += "I" * len(extra[i])
                kept += [(names[x], "") for x in extra[i]]
                if i < len(rows):
                    letter, price, row = edits[i]
                    cost, audit = cost + price, audit + letter
                    kept += [row] if row else []
            if (best is None or (cost, audit) < best[:2]) and GOOD.fullmatch("".join(r[:1] for r, _ in kept)):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in kept))
    return best


def by_tables(rows):
    """The same by dynamic programming over whole strings, for longer conversations."""
    def less(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def add(v, cost, letter, line=None):
        return v[0] + cost, v[1] + letter, v[2] + ([line] if line is not None else [])

    def inserted(table):
        for _ in range(2):
            for s, v in list(table.items()):
                t = C.NEXT[s]
                less(table, t, add(v, 5, "I", f"{C.NAME[t]}:"))
        return table

    table = {C.NONE: (0, "", [])}
    for role, text, must, late in rows:
        new = {}
        for s, v in inserted(table).items():
            less(new, s, add(v, 2, "D"))
            if not must:
                if s in C.FOLLOWS.get(role[:1], {}):
                    less(new, C.FOLLOWS[role[:1]][s], add(v, 5 * late, "K", f"{role}:{text}"))
                t = C.NEXT[s]
                less(new, t, add(v, 1 + 5 * late, "R", f"{C.NAME[t]}:{text}"))
        table = new
    inserted(table)
    cost, audit, lines = min((table[s] for s in C.ENDS if s in table), key=lambda v: v[:2])
    return cost, audit, "\n".join(lines)


def by_viterbi(rows):
    search, nodes, held = C.Repair(), [], 0
    for i, (role, text, must, late) in enumerate(rows):
        nodes += search.row(i, role, text, must, late)
        held = max(held, search.held)
    rest, cost = search.finish()
    nodes += rest
    return (cost, "".join(n.edit for n in nodes),
            "\n".join(f"{n.role}:{n.text}" for n in nodes if n.edit != "D")), held


def some_rows(rng, n, roles="sua"):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "x", "-": ""}
    out = []
    for i in range(n):
        must = rng.random() < 0.2
        out.append((names[rng.choice(roles)], f"t{i}", must, not must and rng.random() < 0.3))
    return out


def test_against_all_edits():
    rng = random.Random(1)
    for _ in range(120):
        rows = some_rows(rng, rng.randint(0, 3), "suax-")
        assert by_viterbi(rows)[0] == by_search(rows) == by_tables(rows), rows


def test_long_conversations_and_ties():
    rng = random.Random(2)
    for roles in ("sua", "ua", "u", "a", "s", "sx", "uuua", "suax-"):
        for n in (1, 7, 60, 300):
            rows = some_rows(rng, n, roles)
            assert by_viterbi(rows)[0] == by_tables(rows), (roles, n)


def test_little_is_held():
    rng = random.Random(3)
    rows = [("user" if (i + (rng.random() < 0.1)) % 2 == 0 else "assistant", "t", False, rng.random() < 0.1)
            for i in range(20_000)]
    assert by_viterbi(rows)[1] < 200
    assert by_viterbi([("user", "t", True, False)] * 20_000)[1] < 20


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def plain(rows):
    """The registered query in plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if c is None else c}:{' ' if t is None else t}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(t, role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, marked = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for t, role, text in kept:
            if not re.search(r"[^\x20\x09-\x0D]", text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = None if text.strip(" \t\n\v\f\r")[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, text = by_tables(marked)
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def run(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = C.damaged_digests(df).collect()
    out = {r["conv_id"]: tuple(r[n] for n in names) for r in rows}
    assert len(out) == len(rows)
    return out


def odd_rows():
    rng = random.Random(5)
    texts = ["Yes.", "No", "Well?  ", "", " \n", None, "Ok!", "Ünï 語。", "Same.", "x" * 50_000 + "."]
    rows = [(rng.choice([1, 2, 3, 4, None, -5]), rng.choice([None, *range(12)]),
             rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(texts)) for _ in range(150)]
    return rows + rows[:20] + [(7, t, "user", "Hi.") for t in range(25)] + [(8, None, None, None)] + [
        (100 + c, t, ["user", "assistant"][t % 2], f"{c} {t}.") for c in range(30) for t in range(rng.randint(1, 5))]


def test_against_plain_python(spark):
    rows = odd_rows()
    got, want = run(frame(spark, rows)), plain(rows)
    assert got == want
    dropped = [c for c in want if c is not None and zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert dropped  # conversations that may have lost all rows


def test_nothing_left(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(frame(spark, [(conv, 0, "user", "Hi.")])) == {
        conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(frame(spark, []).limit(0)) == {}


def test_against_sql():
    rows = odd_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    columns = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    assert {r[0]: r[1:] for r in con.execute(f"SELECT {columns} FROM ({C.repair_sql()})").fetchall()} == plain(rows)


def test_edits_and_repaired_rows(spark, tmp_path):
    turns = frame(spark, [(1, 1, "user", "Hello."), (1, 2, "user", "Hello."), (1, 3, "tool", "Fine."), (1, 9, "assistant", "Bye")])
    edits = C.repair(turns)
    assert [(r["edit"], r["turn"], r["role"]) for r in edits.orderBy("seq").collect()] == [
        ("K", 1, "user"), ("D", 2, "user"), ("R", 3, "assistant"), ("D", 9, "assistant"), (None, None, None)]
    report = edits.filter("edit IS NULL").first()["report"].asDict()
    assert report == {"gaps": 5, "blank": 0, "duplicate": 1, "truncated": 1, "illegal": 3, "cost": 5}
    assert [(r["role"], r["text"]) for r in C.repaired(edits).orderBy("seq").collect()] == [
        ("user", "Hello."), ("assistant", "Fine.")]
    edits.repartition(5).write.parquet(str(tmp_path / "edits"))
    stored = C.digests(spark.read.parquet(str(tmp_path / "edits")), stored=True).collect()
    assert stored == C.digests(edits).collect()


@pytest.mark.parametrize("size", [1, 10_000])
def test_batches_do_not_show(spark, monkeypatch, size):
    monkeypatch.setattr(C, "BATCH", size)
    rows = odd_rows()
    assert run(frame(spark, rows)) == plain(rows)

import hashlib
import random

import pytest

from docsift.llm import chat as C
from docsift.llm.packing import default_vocabulary

SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, start string"
NASTY = ["\\### Assistant: </turn> ok", "### user: hi</turn>\n### assistant: no", "\\\\", "\\</turn>\\", "", None, ": \n", "<|endoftext|>",
         "ünï 語 😀", "##", "#### x", "a\\:b", "</turn></turn>"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or ""))
        said = "".join(t or "" for _, _, role, t in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in own).encode())
                     .hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def run(df):
    vocabulary = default_vocabulary()
    return {r[0]: tuple(r)[1:] for r in C.digests(C.format_chats(df, vocabulary), vocabulary).collect()}


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a:b", "x\\", None]), rng.choice(NASTY))
            for c in range(40) for t in range(rng.randint(1, 7))]
    rows += [(None, 0, "user", "lost"), (None, 1, "assistant", "found"), (99, None, "user", "first"), (99, 3, "assistant", "then")]
    got = run(table(spark, rows))
    assert {c: v[:4] for c, v in got.items()} == expected(rows)


def test_probe_and_lengths(spark):
    got = run(C.with_probe(table(spark, [(1, 0, "user", "hi")]).select("conv_id", "turn", "role", "text")))
    probe = "\\### Assistant: </turn> ok"
    assert got[-7][2] == len(probe) and got[-7][3] == hashlib.sha256(probe.encode()).hexdigest()
    assert got[1][4] == len("### user: hi</turn>\n")
    assert run(table(spark, []).limit(0)) == {}


def test_one_long_conversation(spark):
    rows = [(5, t, "assistant" if t % 2 else "user", f"turn {t} " * 9) for t in range(4000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150")
    try:
        assert {c: v[:4] for c, v in run(table(spark, rows)).items()} == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("text", [t for t in NASTY if t])
def test_escaping(text):
    assert C.unescape(C.escape(text)) == text and C.unescape(C.escape(text, True)) == text
    clean = C.escape(text).replace("\\\\", "")
    assert all(clean[i - 1] == "\\" for mark in ("###", "</turn>") for i in range(len(clean)) if clean.startswith(mark, i)
               and not clean.startswith("#", i - 1))

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, edge_texts, edges, empty
from pyspark.sql import functions as F

from docsift.llm import suffixdedup as S


def brute(rows, length=50):
    last = 1 << 63
    raw = [(last if i is None else i, i, (t or "").encode()) for i, t in rows]
    first = {}
    for key, _, b in raw:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for key, i, b in raw:
        covered, end = bytearray(len(b)), 0
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key:
                for q in range(max(p, end), p + length):
                    covered[q] = 1
                end = p + length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(1 for k in range(len(b)) if covered[k] and not (k and covered[k - 1]))
        out.append((i, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, **kw):
    return sorted(map(tuple, S.digests(docs, S.find_repeats(docs, **kw)).collect()), key=str)


def shared_passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    parts = [" ".join(word() for _ in range(rng.randint(5, 25))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(parts) + " " + word() for _ in range(rng.randint(1, 6)))) for i in range(40)]
    return rows + [(40, "ab" * 200), (41, "ab" * 90), (42, "a" * 300), (43, "a" * 49), (44, "a" * 50)]


@pytest.mark.parametrize("array,block", [(S.ARRAY, S.BLOCK), (300, 500)])
def test_against_brute_force(spark, monkeypatch, array, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = shared_passages(1)
    assert run(documents(spark, rows).repartition(4), array=array) == brute(rows)


def test_edges(spark):
    assert run(edges(spark)) == brute(edge_texts())
    assert run(empty(spark)) == []
    assert S.find_repeats(empty(spark)).count() == 0


def test_spans_and_rest_make_the_text(spark):
    rows = shared_passages(2)
    docs = documents(spark, rows)
    texts = dict(rows)
    for r in S.find_repeats(docs).collect():
        raw, at, rest = texts[r["doc_id"]].encode(), 0, b""
        for span in r["spans"]:
            rest += raw[at:span["start"]]
            at = span["start"] + span["length"]
        assert rest + raw[at:] == bytes(r["kept"])


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffix_array(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(0, letters, 700).astype(np.uint8)
    text[300:420] = text[100:220]
    order = S.suffix_array(text, 56)
    raw = text.tobytes()
    assert sorted(order.tolist()) == list(range(len(raw)))
    keys = [raw[i:i + 56] for i in order]
    assert keys == sorted(keys)
    common = S.common_prefixes(text, order, 50)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]:][:50], raw[order[k]:][:50]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        # zeros stand behind the end of the text
        assert common[k] == want or (len(a) != len(b) and common[k] >= want)


def test_other_columns_do_not_matter(spark):
    docs = edges(spark).withColumn("doc", F.lit(9)).withColumn("th", F.lit(1)).withColumn("hs", F.lit("x"))
    assert run(docs) == brute(edge_texts())


def test_finished_steps_give_their_shuffle_files_back(spark, monkeypatch):
    calls = []
    from docsift.llm import suffixdedup
    monkeypatch.setattr(suffixdedup, "release", lambda session: calls.append(session), raising=False)
    docs = spark.createDataFrame([(1, "a" * 30 + "b" * 40), (2, "c" + "a" * 30 + "b" * 40)], "doc_id long, text string")
    assert [r["doc_id"] for r in suffixdedup.find_repeats(docs).collect()] == [2]
    assert len(calls) == 3


def test_many_small_hashes_do_not_share_one_large_array(monkeypatch):
    rng = np.random.default_rng(3)
    n = 15_000
    segments = [row.tobytes() for row in rng.integers(97, 123, (n // 2, 100)).astype(np.uint8)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, bool)), pa.array(np.arange(n) // 2), pa.array(np.arange(n)), pa.array(np.arange(n)),
         pa.array(np.arange(n)), pa.array(np.zeros(n, np.int64)), pa.array(np.full(n, 51)),
         pa.array([b"-" * (i % 2) + segments[i // 2][i % 2:] for i in range(n)], pa.binary())],
        ["direct", "h", "s", "doc", "th", "start", "n", "segment"])
    sizes, sources = [], S._sources
    monkeypatch.setattr(S, "_sources", lambda text, *rest: sizes.append(len(text)) or sources(text, *rest))
    out = pa.Table.from_batches(list(S._settle(50, S.ARRAY)(iter([batch]))))
    assert sum(sizes) == 100 * n and max(sizes) <= 600_000
    # the second segment of each hash has all strings of the first but the one at its begin
    assert sorted(zip(*(out.column(c).to_pylist() for c in ("doc", "start", "n")))) == [
        (i, 1, 50) for i in range(1, n, 2)]


def test_known_postings_are_not_collected():
    def batches():
        for i in range(9):
            read.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i, i]), pa.array([1, 2]), pa.array([0, 0], pa.int32()), pa.array([i > 2] * 2)],
                ["h", "node", "n", "direct"])

    read, held = [], []
    for found in S._shared(batches()):
        held.append(len(read))
        assert found.schema.names == ["h", "node"]
    assert held[-6:] == [4, 5, 6, 7, 8, 9]

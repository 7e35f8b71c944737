import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, edge_texts, edges, empty
from tokenizers import Tokenizer

from docsift.llm.packing import END, Encoder, default_vocabulary, pack

full = Tokenizer.from_file(default_vocabulary())


def ids_of(text):
    return [*full.encode(text or "", add_special_tokens=False).ids, END]


@pytest.mark.parametrize("length", [64, 2048])
def test_every_id_lies_in_one_piece(spark, length):
    rows = list(enumerate(t for _, t in edge_texts()))
    want = {i: ids_of(t) for i, t in rows}
    pieces = pack(documents(spark, rows).repartition(3), default_vocabulary(), length).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["doc_tokens"] == len(want[p["doc_id"]])
        part = want[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"], p["sequence_length"]))
    for i, own in by_doc.items():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
        assert sum(own[-1]) == len(want[i])
    assert set(by_doc) == set(want) and sorted(by_sequence) == list(range(len(by_sequence)))
    for k, own in sorted(by_sequence.items()):
        own.sort()
        used = sum(n for _, n, _ in own)
        assert own[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:]))
        assert used == length or k == len(by_sequence) - 1
        assert {p for _, _, p in own} == {used if used & (used - 1) == 0 else length}


def test_edges(spark):
    rows = pack(edges(spark), default_vocabulary()).collect()
    assert sum(r["length"] for r in rows) == sum(len(ids_of(t)) for _, t in edge_texts())
    assert pack(empty(spark), default_vocabulary()).collect() == []


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a  b", "a   b ", "x\n y\n\n z", "tabs\tand\u00a0more", "<|endoftext|> here", "don't 12 3.5 語😀 ñ",
    " lead", "trail ", "\r\n x", "a \n b"])
def test_ids_are_those_of_the_tokenizer(text):
    encoder = Encoder(default_vocabulary())
    for _ in range(2):  # the second time from memory
        assert np.frombuffer(encoder(text), "<u4").tolist() == full.encode(text, add_special_tokens=False).ids
    plain = Encoder(default_vocabulary(), plain=True)
    assert plain.decode(plain(text)) == text

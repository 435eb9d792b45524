"""Harmonic packing: ids of the library, every id in one piece, gapless sequences and little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers

from pedalflow.llm import harmonic, queries

PATH = queries.BYTE_VOCABULARY
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def library_ids(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check_pieces(pieces, docs, most_padding):
    """``pieces`` as (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset); ``docs`` as (doc_id, text), ids unique."""
    ids = {d: library_ids(t or "") + np.array([1], "<u4").tobytes() for d, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, tokens, sequence, offset in pieces:
        assert length > 0 and tokens == len(ids[doc_id]) // 4
        assert crc == zlib.crc32(ids[doc_id][4 * start : 4 * (start + length)])
        by_doc[doc_id].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert by_doc.keys() == ids.keys()
    for groups, total in ((by_doc, lambda d, n: n == len(ids[d]) // 4), (by_sequence, lambda s, n: n <= 2048)):
        for key, spans in groups.items():
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert total(key, at)
    filled = [sum(n for _, n in spans) for spans in by_sequence.values()]
    padding = sum(2048 - n for n in filled if n & (n - 1))
    assert padding <= most_padding * sum(filled)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_packs_every_id_once(spark, scale):
    folder = f"/root/testdata/{scale}"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op12_harmonic_packing(spark, folder)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {f.name: f.dataType.simpleString() for f in found.schema} == dict.fromkeys(columns, "bigint")
    check_pieces([tuple(r) for r in found.select(*columns).collect()], docs, 0.005)


def test_workers_fill_their_own_bins(spark, docs_of):
    """The same texts over many tasks: still whole, still little padding."""
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "été", "中文"], k=rng.choice([3, 40, 700, 3000])))) for i in range(200)]
    found = harmonic.packed(docs_of(docs).repartition(23), PATH).collect()
    assert len({r["sequence_id"] for r in found}) == len(found)
    pieces = []
    for r in found:
        assert len(r["ids"]) == 4 * (r["tokens"] if r["tokens"] & (r["tokens"] - 1) == 0 else 2048)
        for p in r["pieces"]:
            own = r["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])]
            pieces.append((p["doc_id"], p["start"], p["length"], zlib.crc32(own), p["doc_tokens"], r["sequence_id"], p["offset"]))
    check_pieces(pieces, docs, 0.005)


def test_classes_take_a_fixed_count():
    """Full bins hold as many pieces as their class says; the rest is powers of two."""
    rng = random.Random(2)
    for length in range(1, 5000):
        pieces = harmonic.cut(length)
        assert sum(pieces) == length and all(p & (p - 1) == 0 or 2048 % p <= 16 for p in pieces)
    packer, full = harmonic.Packer(2048), []
    for i in range(3000):
        full += packer.add(i, bytes(4 * rng.randint(1, 3000)))
    for held in full:
        assert len({2048 // p[2] for p in held}) == 1 and len(held) == 2048 // held[0][2]
        assert 2048 - sum(p[2] for p in held) <= 16
    left = sum(p[2] for held in packer.open.values() for p in held)
    closed = [sum(p[2] for p in held) for held in packer.close()]
    assert sum(closed) == left and all(n & (n - 1) == 0 for n in closed) and len({n for n in closed if n < 2048}) == sum(n < 2048 for n in closed)


def test_ids_are_those_of_the_library():
    own = harmonic.encoder(PATH)
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b {c} {c}1 x{c}", f" {c}{c} '{c}", f"a {c}", f"{c} a", f"a  {c}\n {c}"):
            assert own.encode(text) == library_ids(text), repr(text)
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "é", "1", "'s", "'ll", ".", "Ω", "中", " ", "\x85", "\x1c", "<|endoftext|>", "word", "!!", "࢏", "\U0001f600", "é"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert own.encode(text) == library_ids(text), repr(text)
    assigned = [chr(c) for c in range(0x250, 0x20000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(assigned), 40):
        text = "".join(f"a{c} {c}" for c in assigned[at : at + 40])
        assert own.encode(text) == library_ids(text)


def test_edges(spark, docs_of):
    """Null, empty and very long texts, no id, repeated rows, another capacity, no rows."""
    docs = [(1, None), (2, ""), (3, "x" * 100_000), (4, "word " * 100_000), (5, " \n "), (6, "<|endoftext|>")]
    found = harmonic.packed(docs_of([*docs, (None, "nameless"), (9, "twice"), (9, "twice")]), PATH, 512).collect()
    pieces = [p for r in found for p in r["pieces"]]
    for doc_id, text in docs:
        own = [p for p in pieces if p["doc_id"] == doc_id]
        assert sum(p["length"] for p in own) == own[0]["doc_tokens"] == len(library_ids(text or "")) // 4 + 1
    assert sum(p["start"] == 0 for p in pieces if p["doc_id"] == 9) == 2 and any(p["doc_id"] is None for p in pieces)
    assert max(r["tokens"] for r in found) == 512
    assert harmonic.packed(docs_of([]), PATH).collect() == []
    with pytest.raises(ValueError):
        harmonic.packed(docs_of([]), PATH, 1000)

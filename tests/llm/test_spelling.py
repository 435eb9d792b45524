"""Spelling variants against all pairs and plain counts."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers_llm import rows

from pedalflow.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(docs):
    """Each word with form, root, n, n_near and form_n, by the words of the task."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    # Words one edit apart share their first or their last three letters.
    ends = {}
    for w in counts:
        ends.setdefault(("first", w[:3]), set()).add(w)
        ends.setdefault(("last", w[-3:]), set()).add(w)
    out = {}
    for w, n in counts.items():
        near = [v for v in ends["first", w[:3]] | ends["last", w[-3:]] if one_edit(w, v)]
        form = min(near, key=lambda v: (-counts[v], v), default=None)
        if form is not None and counts[form] < 5 * n:
            form = None
        out[w] = [form, None, n, len(near), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    return {w: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for w, r in rows(df, "word").items()}


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = found(queries.op11_spelling_variants(spark, folder))
    assert got == plain_variants(docs)
    assert sum(v[0] is not None for v in got.values()) > 100 and any(v[1] != (v[0] or w) for w, v in got.items())


@pytest.mark.parametrize("seed", range(3))
def test_small_alphabet_in_small_tiles(spark, docs_of, monkeypatch, seed):
    """Few letters make many near words; tiles of a few words cut every group."""
    monkeypatch.setattr(spelling, "TILE", 40)
    rng = random.Random(seed)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 7))) for _ in range(500)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([5, 400])))) for i in range(12)]
    docs += [(100 + i, f"{words[i]} " * 5**3) for i in range(8)]
    want = plain_variants(docs)
    assert found(spelling.variants(docs_of(docs))) == want
    assert sum(v[3] for v in want.values()) > 300


def test_chains_lead_to_the_last_form(spark, docs_of):
    counts = {"kangaroo": 625, "kangaro": 125, "kangar": 25, "kangat": 5, "wallaby": 4, "abcdef": 5, "abcdeg": 5}
    text = " ".join(f"{w} " * n for w, n in counts.items())
    # Hashes that delete letters depend on doc_id: take one for which none does.
    doc_id = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{w}".encode()) % 199 for w in counts))
    got = found(spelling.variants(docs_of([(doc_id, text)])))
    assert got["kangat"] == ("kangar", "kangaroo", 5, 1, 25) and got["kangaro"] == ("kangaroo", "kangaroo", 125, 2, 625)
    assert got["abcdef"] == (None, "abcdef", 5, 1, None) and "wallaby" not in got


def test_a_shortened_word_is_not_looked_at_again():
    """What a hash has made of one run may be another run of the text, whose own hash says otherwise."""
    pick = lambda i, w: zlib.crc32(f"{i}:{w}".encode())
    for i in range(3_000_000):
        long, short = "abcdefgh", "abcdefg"
        if pick(i, long) % 199 == 0 and pick(i, long) % 8 == 7 and pick(i, short) % 199 == 0:
            break
    at = pick(i, short) % 7
    assert spelling.words_of(str(i), f"{long} {long} {short}") == Counter({short: 2, short[:at] + short[at + 1 :]: 1})


def test_edges(spark, docs_of):
    """Null and empty texts, no id, repeated rows, very long words and texts, a hash that deletes, no rows."""
    long = "z" * 70_000
    deleted = next(w for w in ("w" + "x" * k + "yz" for k in range(5, 5000)) if zlib.crc32(f"7:{w}".encode()) % 199 == 0)
    docs = [(1, None), (2, ""), (None, "Nameless nameless"), (3, f"{long} {long[1:]} " * 5), (7, f"{deleted} " * 6), (8, "Straße ×÷×÷×÷ " * 5)]
    docs += [(4, "repeat words-repeat")] * 3 + [(None, "nameless")] * 3 + [(5, "word " * 50_000 + "nearly " * 9)]
    got = found(spelling.variants(docs_of(docs)))
    assert got == plain_variants(docs)
    assert got[long][3] == 1 and "straße" in got and deleted not in got
    assert spelling.variants(docs_of([])).collect() == []
    assert spelling.variants(docs_of([(1, "only short ones"), (2, None)])).collect() == []

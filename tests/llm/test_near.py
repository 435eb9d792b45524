"""Near copies by shingles, against all pairs, edited copies among them."""

import numpy as np
from helpers_llm import brute

from pedalflow.llm import near


def prose(seed, n=200):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 5000, n)]


def edited(words, *places):
    out = list(words)
    for p in places:
        out[p] = "changed"
    return " ".join(out)


def all_pairs(texts):
    """Least id reachable over links at 0.8 or more."""
    sets = {i: set(brute.shingles(t, 5)) for i, t in texts.items()}
    root = {i: i for i in texts}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or len(a & b) >= 0.8 * len(a | b)):
                x, y = sorted((root[i], root[j]))
                root = {k: x if r == y else r for k, r in root.items()}
    return root


def test_edited_copies_leave_one_document(spark, docs_of):
    """Copies with two words changed differ by more than 4 bits of SimHash, in most cases."""
    originals = {i: prose(i) for i in range(30)}
    rows = [(i, " ".join(w)) for i, w in originals.items()] + [(100 + i, edited(w, 60, 140)) for i, w in originals.items()]
    apart = [(brute.fingerprint(rows[i][1]) ^ brute.fingerprint(rows[30 + i][1])).bit_count() for i in range(30)]
    assert sum(d > 4 for d in apart) > 10
    found = near.near_duplicates(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] == r["component_id"]) == list(range(30))


def test_components_are_those_of_all_pairs(spark, docs_of, monkeypatch):
    """Copies near and far, chains, short and equal texts, over several tiles."""
    monkeypatch.setattr(near, "TILE", 3)
    texts = {k: edited(prose(k % 4), *range(7, 7 + 9 * (k // 4), 9)) for k in range(40)}
    texts |= {50: "a b c", 51: "A  b\tc", 52: "a b d", 53: "", 54: " ", 55: " ".join(prose(0)[:150] + prose(9)[:50])}
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs_of(list(texts.items()))).collect()}
    assert found == all_pairs(texts)
    assert len(set(found.values())) < len(texts) - 20

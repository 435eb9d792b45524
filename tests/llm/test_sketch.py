"""Likeness of documents from their written fingerprints, and against exact containment, short texts included."""

import numpy as np
import pytest
from helpers_llm import brute, rows
from pyspark.sql import functions as F

from pedalflow.llm import sketch

SF = "/root/testdata/sf0.01"


def likeness(one, two):
    a, b = (set(brute.shingles(t, 5)) for t in (one, two))
    if one == two:
        return 1.0, 1.0
    return len(a & b) / (min(len(a), len(b)) or 1), len(a & b) / (len(a | b) or 1)


def from_written(one, two, equal):
    """Containment and similarity of two written fingerprints, by the words of the module."""
    a, b = ({int(f[k : k + 16], 16) for k in range(0, len(f), 16)} for f in (one, two))
    top = 2**64
    for s in (a, b):
        if len(s) >= 64:
            top = min(top, max(max(s), 2**62 - 1))
    a, b = ({h for h in s if h <= top} for s in (a, b))
    if equal:
        return 1.0, 1.0
    return (len(a & b) / min(len(a), len(b)) if a and b else 0.0), len(a & b) / max(1, len(a | b))


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_likeness_is_that_of_the_fingerprints(texts, docs_of):
    short = ["a b c d e f g h i j k l", "a b c d e f g h i j k z", "a b c", "A b  c", "", "one"]
    errors = []
    for case in (texts, dict(enumerate(short))):
        found = rows(sketch.edited_sketches(docs_of(list(case.items()))), "doc_id")
        ids = sorted(case)
        for at, i in enumerate(ids):
            r, text, after = found[i], case[i], case[ids[(at + 1) % len(ids)]]
            edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
            following = found[ids[(at + 1) % len(ids)]]["fingerprint"]
            assert bool(r["fingerprint"]) == bool(text.split())
            assert (r["near_edited"], r["jaccard_edited"]) == from_written(r["fingerprint"], r["edited_fingerprint"], text == edited)
            assert (r["near_next"], r["jaccard_next"]) == from_written(r["fingerprint"], following, text == after)
            exact = likeness(text, edited)
            if max(len(brute.shingles(t, 5)) for t in (text, edited)) < 64:
                assert (r["near_edited"], r["jaccard_edited"]) == pytest.approx(exact)
            errors.append(abs(r["near_edited"] - exact[0]))
    assert np.mean(errors) < 0.03 and max(errors) < 0.25


def test_sketches_of_parts_merge_into_that_of_the_whole(texts):
    sets = [sketch.shingle_set(t) for t in list(texts.values())[:60]]
    for a, b in zip(sets, sets[1:], strict=False):
        assert np.array_equal(sketch.merged(sketch.kept(a), sketch.kept(b)), sketch.kept(np.union1d(a, b)))
        assert np.array_equal(sketch.read(sketch.written(sketch.kept(a))), sketch.kept(a))


def test_ids_of_any_type(texts, docs_of):
    docs = docs_of(list(texts.items())[:200])
    name = F.format_string("%06d", "doc_id")
    plain = {f"{i:06d}": r for i, r in rows(sketch.edited_sketches(docs), "doc_id").items()}
    named = rows(sketch.edited_sketches(docs.withColumn("doc_id", name)), "doc_id")
    assert {i: tuple(r)[1:] for i, r in named.items()} == {i: tuple(r)[1:] for i, r in plain.items()}

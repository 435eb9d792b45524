"""What the boosted trees add to the base spans: by labels they do not see, over whole tables and in planted texts."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pedalflow.llm import pii


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def chooser(documents):
    return pii.fit_chooser(documents)


def test_trees_do_not_see_what_labels_are_made_of():
    assert not {"luhn", "octets", "tld"} & set(pii.FEATURES)


def test_secrets_of_the_table_are_chosen(documents, chooser):
    found = pii.find_personal(documents, chooser).collect()
    secrets = {(r["doc_id"], m.start(), m.end()) for r in found for m in re.finditer(r'token = "[0-9a-f]{40}"', r["text"])}
    chosen = {(r["doc_id"], s["start"], s["end"]) for r in found for s in r["spans"] if s["kind"] == "secret"}
    assert len(secrets) >= 10 and chosen == secrets


def test_chosen_and_clean_spans_of_planted_texts(docs_of, chooser):
    """Values in the format of secrets go whatever their name; prose, dates, prices and versions stay."""
    hidden = ['key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"', 'api_key: "2c26b46b68ffc68ff99b453c1d30413413422d70"']
    clean = ["In 1998 the 12 men paid 1,250.50 for 3 x 4 boards", "version = 1.2.3 and title = \"abc\"", "from 2001-02-03 to 2004-05-06", "a = b"]
    docs = [(i, f"some words before {h} and some words after") for i, h in enumerate(hidden)] + [(10 + i, t) for i, t in enumerate(clean)]
    found = {r["doc_id"]: r for r in pii.find_personal(docs_of(docs), chooser).collect()}
    for i, h in enumerate(hidden):
        start = found[i]["text"].index(h)
        assert [(s["kind"], s["start"], s["end"]) for s in found[i]["spans"]] == [("secret", start, start + len(h))]
    assert not [s for i in range(len(clean)) for s in found[10 + i]["spans"]]


@pytest.mark.parametrize("fitted_by", [lambda spark, docs: pii.fit_chooser(docs), lambda spark, docs: corpus_pipeline.redact_personal_data(spark, docs, "")])
def test_every_document_counts(spark, docs_of, fitted_by):
    """A secret in one document in twenty, among twice as many documents as were once drawn."""
    hexes = [f"ab{i * 2654435761 % 2**64:016x}{i:08x}" for i in range(8000)]
    mixed = lambda i: f'token = "{hexes[i]}"' if i % 20 == 0 else f'title = "chapter_{i % 7}" in 1{i % 10} parts'
    seen = []

    def spied(df, label, keep=pii.stored):
        seen.append(keep(df, label))
        return seen[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "stored", spied)
        fitted_by(spark, docs_of([(i, mixed(i)) for i in range(8000)]))
    labels = {r["label"]: r["n"] for r in seen[0].groupBy("label").agg(F.sum("count").alias("n")).collect()}
    assert labels == {1.0: 400, 0.0: 7600}


def _of_half(spark, half, n):
    """The first ids whose documents belong to a half."""
    return [r["id"] for r in spark.range(20 * n).where(F.pmod(F.xxhash64("id"), F.lit(2)) == half).limit(n).collect()]


def _planted(i, secret):
    return f'token = "ab{i * 2654435761 % 2**64:016x}{i:022x}"' if secret else f'title = "chapter_{i % 7}" in 1{i % 10} parts'


@pytest.mark.parametrize("fits", [0, 1])
def test_trees_come_from_either_half(spark, docs_of, fits):
    """One half has both labels, the other has secrets alone: it cannot fit trees, and sets the thresholds of the other's."""
    both, alone = _of_half(spark, fits, 60), _of_half(spark, 1 - fits, 60)
    docs = docs_of([(i, _planted(i, k % 2)) for k, i in enumerate(both)] + [(i, _planted(i, True)) for i in alone])
    found = pii.find_personal(docs, pii.fit_chooser(docs)).collect()
    secret = {*both[1::2], *alone}
    assert {r["doc_id"] for r in found if [s for s in r["spans"] if s["kind"] == "secret"]} == secret


@pytest.mark.parametrize("fitted_by", [lambda spark, docs: pii.fit_chooser(docs), lambda spark, docs: corpus_pipeline.redact_personal_data(spark, docs, "")])
def test_trees_and_thresholds_take_all_documents(spark, docs_of, monkeypatch, fitted_by):
    """The rows that fit trees, and those whose scores set thresholds, are each all of the documents."""
    fitted, scored = [], []

    class Spied(pii.GBTClassifier):
        def fit(self, rows):
            fitted.append(rows.agg(F.sum("count")).first()[0])
            return super().fit(rows)

    def spied(self, x, score=pii.Chooser.score):
        scored.append(self.trees)
        return score(self, x)

    monkeypatch.setattr(pii, "GBTClassifier", Spied)
    monkeypatch.setattr(pii.Chooser, "score", spied)
    fitted_by(spark, docs_of([(i, _planted(i, i % 4 == 0)) for i in range(400)]))
    assert len(fitted) == 2 and sum(fitted) == 400 and min(fitted) > 0
    assert len(scored) >= 2 and len(scored[0]) == len(scored[1]) == pii.TREES


def test_no_row_is_drawn_for_splits():
    """Spark draws rows if there are more than the square of the splits."""
    assert pii.bins(0) == pii.bins(pii.BINS**2) == pii.BINS
    assert all((pii.bins(n) - 1) ** 2 < n <= pii.bins(n) ** 2 for n in (pii.BINS**2 + 1, 10**7, 10**9 + 7))

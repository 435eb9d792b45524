"""Ids and decoded texts against the library: every letter it may read differently, and mixed texts."""

import random

import numpy as np
import pytest
import tokenizers

from pedalflow.llm import bpe, queries

LIBRARY = tokenizers.Tokenizer.from_file(queries.VOCABULARY)


def of_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(queries.VOCABULARY)


def test_every_code_point(tokenizer):
    encoder = bpe.Encoder(tokenizer, None)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 97 == 0)]
    for c in points[:0x300]:
        for text in (f"a{c}b {c} {c}1 X{c}", f"{c}{c}'s", f" {c}\n{c} A"):
            assert encoder.encode(text) == of_library(text), repr(text)
    for at in range(0, len(points), 30):
        text = "".join(f"a{c}B {c} " for c in points[at : at + 30])
        assert encoder.encode(text) == of_library(text), repr(text)


def test_mixed_texts_with_and_without_lexicon(tokenizer):
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "a", "É", "ß", "1", "'s", "'LL", ".", "Ω", "Σ", "中", "\x85", "\x1c", "<|endoftext|>", "Word", "words", "!!", "࢏", "é", "\xad"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    lexicon = bpe.Lexicon.mapped(bpe.Lexicon.compile({w: tokenizer.merged(w) for w in ("a", "word", "words", "é", "ss")}).packed())
    assert lexicon.find("words") == tokenizer.merged("words") and lexicon.find("wor") is None and lexicon.find("wordsx") is None
    for encoder in (bpe.Encoder(tokenizer, None), bpe.Encoder(tokenizer, lexicon)):
        for text in texts:
            assert encoder.encode(text) == of_library(text), repr(text)


def test_words_met_before_change_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    encoder = bpe.Encoder(tokenizer, None)
    rng = random.Random(9)
    for _ in range(200):
        text = " ".join(rng.choices(["one", "two", "three", "four", "five", "six", "seven"], k=6))
        assert encoder.encode(text) == of_library(text)


def test_lexicon_is_of_the_vocabulary_and_reads_no_document(spark, docs_of, tokenizer):
    words = tokenizer.whole_words()
    assert len(words) > 20_000 and {"the", "water", "é"} <= set(words)
    texts = ["The water of the zyxwvq zyxwvq", "été", None]
    context = spark.sparkContext
    context.setJobGroup("encoded", "encoded")
    try:
        found = bpe.encoded(docs_of(list(enumerate(texts))), queries.VOCABULARY)
        assert not context.statusTracker().getJobIdsForGroup("encoded")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in found.collect()} == {i: of_library(t or "") for i, t in enumerate(texts)}

"""Nulls, empty and odd texts, repeated rows, clashing columns and empty tables, for the operators on documents."""

import pytest
from helpers_llm import brute

from pedalflow.llm import bpe, chat, language_id, lm_scoring, packing, pii, quality, queries, simhash, sketch, url_filter

OPERATORS = {
    "pii": lambda df: pii.find_personal(df, pii.fit_chooser(df)).select("doc_id", pii.joined("base").alias("base")),
    "quality": quality.quality_verdicts,
    "simhash": simhash.near_duplicates,
    "sketch": sketch.edited_sketches,
    "bpe": lambda df: bpe.encoded(df, queries.VOCABULARY),
    "language": lambda df: language_id.predicted(df, language_id.fit(df, df["doc_id"].isNotNull())),
    "packing": lambda df: packing.packed(packing.with_clusters(df)),
    "lm": lm_scoring.scored,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edges(spark, docs_of, name):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "src0") for i, t in enumerate(brute.EDGE_TEXTS)]
    rows += [rows[8], (None, "no id here at all", "en", None)]
    found = OPERATORS[name](docs_of(rows)).collect()
    assert {r["doc_id"] for r in found} == {None, *range(len(brute.EDGE_TEXTS))}
    by_id = {r["doc_id"]: r for r in found}
    for i, text in enumerate(brute.EDGE_TEXTS):
        if name == "pii":
            assert by_id[i]["base"] == brute.personal(text)
        if name == "quality":
            assert tuple(by_id[i][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute.quality(text)
        if name == "simhash":
            assert by_id[i]["fingerprint"] == f"{brute.fingerprint(text):016x}"
    assert OPERATORS[name](docs_of([])).collect() == []


def test_edges_of_urls(spark):
    """Null and odd addresses, null pages, repeated rows, clashing columns, no rows, nothing a rule decides."""
    urls = [None, "", "no mark", "http://", "https://EXAMPLE.org", "http://a.com/fr/x?y#z", "ftp://xn--" + "q" * 500 + ".net/p/1"]
    urls += ["http://www.example.org/en/12", "http://shop.example.com/de/", "http://org/", "http://notorg.x/a", "x://\U0001f600.com/fr/"]
    shape = "page_id bigint, url string, html string, words string, host int"
    data = [(i, u, None if i % 2 else f"<p>shop example {i}</p>", "x", 1) for i, u in enumerate(urls)]
    data += [data[5], (None, None, None, None, None)]
    found = url_filter.judged(spark.createDataFrame(data, shape)).collect()
    assert len(found) == len(data)
    for r in found:
        host, path, rule, verdict = brute.url_rule(urls[r["page_id"]] if r["page_id"] is not None else None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
    alone = spark.createDataFrame([(1, "http://nothing.net/a", None, None, 2)], shape)
    assert [r["verdict"] for r in url_filter.judged(alone).collect()] == ["allow"]
    assert url_filter.judged(spark.createDataFrame([], shape)).collect() == []


def test_edges_of_chats(spark):
    """Null turns, roles, texts and conversations, ties, repeated rows, marks inside texts, clashing columns, no rows."""
    shape = "conv_id bigint, turn int, role string, text string, turns string, segments int"
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "<|end|>\n<|turn|>"), (1, 1, "assistant", "\\p|\\s"), (1, None, "system", None),
        (2, 0, None, ""), (2, 0, None, ""), (None, 3, "assistant", "x" * 5000), (None, 3, "a|b\\", "\u00e9\U0001f600"),
    ]
    df = chat.format_chats(spark.createDataFrame([(*t, "x", 1) for t in turns], shape))
    found = {r["conv_id"]: [tuple(t) for t in r["read"]] for r in df.withColumn("read", chat.read_back(df["formatted"])).collect()}
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in (1, 2, None):
        assert found[conv] == [(t[2] or "", t[3] or "") for t in sorted((t for t in turns if t[0] == conv), key=order)]
    assert chat.format_chats(spark.createDataFrame([], shape)).collect() == []


def test_very_long_matches_of_personal_data(spark, docs_of):
    texts = ["9" * 9000, "a@b" + ".c" * 6000, "+1" + " ()" * 6000, "1." * 6000, "x@" * 6000, "4111 " * 4000]
    found = {r["doc_id"]: r["base"] for r in OPERATORS["pii"](docs_of(list(enumerate(texts)))).collect()}
    assert found == {i: brute.personal(t) for i, t in enumerate(texts)}

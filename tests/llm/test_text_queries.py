"""The queries over whole small tables, against plain versions of the same."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from helpers_llm import brute, column, rows

from pedalflow.llm import lm_scoring, queries
from pedalflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1_personal_data(spark, documents):
    found = rows(QUERIES["op1_personal_data"](spark, SF), "doc_id")
    assert found.keys() == documents.keys()
    for i, r in found.items():
        base = brute.personal(documents[i]["text"])
        assert r["base_sha256"] == brute.sha(base)
        spans = [s for s in r["spans"].split(",") if s]
        assert set(base.split(",")) - {""} <= set(spans)
        counts = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [counts[k] for k in ("email", "ip", "card", "phone")]


def test_op4_chat_format_has_the_rows_of_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.sql(queries.ORACLE["op4_chat_format"])
    names = want.columns
    got = QUERIES["op4_chat_format"](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_op5_bpe_is_the_library_s_result(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.VOCABULARY)
    library.no_padding()
    library.no_truncation()
    found = rows(QUERIES["op5_bpe"](spark, SF), "doc_id")
    assert found.keys() == documents.keys()
    for i, r in found.items():
        ids = library.encode(documents[i]["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert r["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))


def test_op7_language_id_learns_only_from_the_rest(spark, documents):
    found = rows(QUERIES["op7_language_id"](spark, SF), "doc_id")
    assert found.keys() == documents.keys()
    right = total = 0
    for i, r in found.items():
        held = zlib.crc32(str(i).encode()) % 4 == 2
        assert r["held_out"] == held and 0 <= r["score"] <= 1
        if held and documents[i]["lang"] and r["lang_pred"] != "und":
            right, total = right + (r["lang_pred"] == documents[i]["lang"]), total + 1
    assert right >= 0.9 * total


def test_op8_fingerprints(spark, documents):
    found = rows(QUERIES["op8_fingerprints"](spark, SF), "doc_id")
    ids = sorted(documents)
    assert sorted(found) == ids
    for at, i in enumerate(ids):
        text, after = (documents[j]["text"] or "" for j in (i, ids[(at + 1) % len(ids)]))
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        own, other = (brute.kept_hashes(t) for t in (text, edited))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own, other)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1


def test_op9_simhash(spark, documents):
    found = rows(QUERIES["op9_simhash"](spark, SF), "doc_id")
    prints = [(i, brute.fingerprint(r["text"])) for i, r in documents.items()]
    want = brute.components(prints)
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints}
    assert {i: r["component_id"] for i, r in found.items()} == want


def test_op10_quality_rules(spark, documents):
    found = rows(QUERIES["op10_quality_rules"](spark, SF), "doc_id")
    assert found.keys() == documents.keys()
    for i, r in found.items():
        want = brute.quality(documents[i]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want
        assert not (r["kept"] and r["base_failed"])


def test_op10_keeps_good_documents_and_rejects_symbols(spark):
    labels = rows(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    found = rows(QUERIES["op10_quality_rules"](spark, "/root/testdata/sf0.01"), "doc_id")
    judged = [(found[i]["kept"], r["quality"]) for i, r in labels.items() if not found[i]["base_failed"]]
    good = [k for k, q in judged if q == 1]
    bad = [k for k, q in judged if q == 0]
    assert sum(good) == len(good)
    assert sum(bad) <= 0.15 * len(bad)


def test_op2_scores_are_those_of_brute_force(spark, documents):
    found = rows(QUERIES["op2_lm_score"](spark, SF), "doc_id")
    want = brute.backoff({i: r["text"] for i, r in documents.items()})
    assert found.keys() == want.keys()
    for i, (n, score) in want.items():
        assert found[i]["n_tokens"] == n
        assert found[i]["log_score"] == (pytest.approx(score, rel=1e-9) if n else None)


def test_op2_split_ngrams_score_the_same(spark, docs_of):
    """One word, pair and triple in most records: each is split, down to the document."""
    texts = ["up we go " * (5 + i % 3) + f"then {i % 7} home" for i in range(60)] + ["up", "we go up", "", None, "go go go go"]
    found = rows(lm_scoring.scored(docs_of(list(enumerate(texts))), place=20), "doc_id")
    frequent = lm_scoring._frequent(docs_of(list(enumerate(texts))), 0.05, 100)[0]
    assert all(len(f.keys) for f in frequent)
    for i, (n, score) in brute.backoff(dict(enumerate(texts))).items():
        assert found[i]["n_tokens"] == n
        assert found[i]["log_score"] == (pytest.approx(score, rel=1e-9) if n else None)


def test_op2_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "SLICE_CHARS", 10)
    texts = ["abc", None, "x" * 50, "", "abcdefghij", "k", "ll"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    parts = [p.column("text").to_pylist() for p in lm_scoring._slices([batch])]
    assert sum(parts, []) == texts and len(parts) > 3
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in parts)


def test_op3_url_filter(spark):
    pages = rows(spark.read.parquet(f"{SF}/pages.parquet"), "page_id")
    found = rows(QUERIES["op3_url_filter"](spark, SF), "page_id")
    assert found.keys() == pages.keys()
    for i, r in found.items():
        host, path, rule, verdict = brute.url_rule(pages[i]["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or r["verdict"]) and r["verdict"] in ("allow", "block")
        assert r["host_words"].replace(" ", "") == "".join(c for c in host if "a" <= c <= "z")


def test_op6_packing_places_every_word_once(spark, documents):
    found = QUERIES["op6_packing"](spark, SF).collect()
    texts = {i: brute.WORD.findall(r["text"] or "") for i, r in documents.items()}
    brute.check_packing(found, texts, {i: (r["source"], r["text"]) for i, r in documents.items()})


def test_all_are_registered():
    assert sorted(int(column(q)) for q in QUERIES) == list(range(1, 14))

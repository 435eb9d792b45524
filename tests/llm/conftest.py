import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with extra clashing columns."""

    def build(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "src0")), None if r[1] is None else len(r[1]), "x", 1.5) for r in rows]
        names = "doc_id bigint, text string, lang string, source string, n_chars bigint, ws string, score double"
        return spark.createDataFrame(full, names)

    return build

"""Each operator over its whole table, and the same in SQL where SQL can express it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.llm import bpe, chat, harmonic, language_id, lm_scoring, negatives, packing, pii, quality, simhash, sketch, spelling, url_filter
from pedalflow.llm.common import table

#: The public vocabulary of op5; a parameter of the operator.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: That of op12.
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

HARD_TEXT = "\\### Assistant: </turn> ok"


def _hex(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal(docs, pii.fit_chooser(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], _hex(pii.joined("base")).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judged(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"), F.array_join("words", " ").alias("host_words"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.sql("SELECT * FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)").select(
        *[v.cast(turns.schema[c].dataType).alias(c) for c, v in (("conv_id", F.lit(-7)), ("turn", F.col("turn")), ("role", F.col("role")), ("text", F.lit(HARD_TEXT)))]
    )
    return turns.unionByName(hard)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = chat.format_chats(_conversations(spark, sf_dir)).withColumn("read", chat.read_back(F.col("formatted")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescaped(s["text"])), "")
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return df.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        _hex(turns).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        _hex(loss).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encoded(table(spark, sf_dir, "documents"), VOCABULARY)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        _hex(F.col("decoded")).alias("decoded_sha256"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.with_clusters(table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2
    model = language_id.fit(docs, ~held_out("doc_id"))
    return language_id.predicted(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_sketches(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 3).alias("distance")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = harmonic.packed(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)
    pieces = packed.select("sequence_id", "ids", F.explode("pieces").alias("p")).select("sequence_id", "ids", "p.*")
    own = F.substring("ids", F.col("offset") * 4 + 1, F.col("length") * 4)
    return pieces.select("doc_id", "start", "length", F.crc32(own).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_lm_score,
        op3_url_filter,
        op4_chat_format,
        op5_bpe,
        op6_packing,
        op7_language_id,
        op8_fingerprints,
        op9_simhash,
        op10_quality_rules,
        op11_spelling_variants,
        op12_harmonic_packing,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op4_chat_format": rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{HARD_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TEXT}'),
    placed AS (
        SELECT *, lag(role) OVER w AS earlier, row_number() OVER w AS nth FROM turns
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY nth)) AS loss_sha256,
        CAST(sum(length(replace(replace(text, '\', '\s'), '|', '\p'))
            + CASE WHEN earlier = role THEN 8 ELSE 17 + length(replace(replace(role, '\', '\s'), '|', '\p')) END)
            AS BIGINT) AS formatted_chars
    FROM placed GROUP BY conv_id""",
    "op13_hard_negatives": """
    WITH v AS (
        SELECT row_number() OVER () AS nth, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.nth AS anchor, a.vec_id AS anchor_id, b.nth AS other, b.vec_id AS id, a.label = b.label AS alike,
            CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
    positives AS (
        SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
    negatives AS (
        SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.id) AS rank
        FROM positives p JOIN scored n
            ON p.anchor = n.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 3""",
}

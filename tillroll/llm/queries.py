"""The operators of this subpackage as named queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.sharing import scratch_path
from tillroll.llm import (
    alignment,
    archives,
    backoff,
    contamination,
    jaccard,
    language,
    naming,
    packing,
    resampling,
    secrets,
    sharding,
    toxicity,
    viterbi,
)
from tillroll.llm.stages import table

Query = Callable[[SparkSession, str], DataFrame]


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.exact_duplicates(table(spark, sf_dir, "documents"))


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "archives"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(table(spark, sf_dir, "documents"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.score_documents(table(spark, sf_dir, "documents"))
    return scored.withColumn("score", F.round("score", 6))


def secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": ngram_jaccard,
    "op2_warc": arc_to_warc,
    "op3_language_id": language_id,
    "op4_decontamination": decontamination,
    "op5_toxicity": toxic,
    "op6_secret_ledger": secret_ledger,
    "op7_packing": cost_packing,
    "op8_token_counts": token_counts,
    "op9_lm_scoring": lm_scores,
    "op10_exact_dedup": exact_dedup,
    "op11_importance_resampling": importance_resampling,
    "op12_tokenizer_alignment": tokenizer_alignment,
    "op13_sharding": sharded,
    "pipeline": pipeline,
}

# The CRC-32 of the hexadecimal bytes ``digits``, by the rule of its table.
CRC_TABLE = """
    SELECT list_transform(range(256), lambda i:
        list_reduce(range(8), lambda c, step: xor(c >> 1, (c & 1) * 3988292384), i::BIGINT)) AS steps
"""
CRC = """
    xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(digits, '..'), lambda b: ('0x' || b)::BIGINT),
        lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]), 4294967295))
"""

ORACLES: dict[str, str] = {
    "op9_lm_scoring": """
        WITH listed AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ \\t\\n\\v\\f\\r]+') AS words
            FROM documents
        ), placed AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM listed
        ), pairs AS (
            SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM placed
        ), ones AS (
            SELECT doc_id, word, count(*) AS own FROM pairs GROUP BY ALL
        ), one_left AS (
            SELECT doc_id, word, sum(own) OVER (PARTITION BY word) - own AS n FROM ones
        ), twos AS (
            SELECT doc_id, before, word, count(*) AS own FROM pairs WHERE before IS NOT NULL GROUP BY ALL
        ), two_left AS (
            SELECT doc_id, before, word, sum(own) OVER (PARTITION BY before, word) - own AS n FROM twos
        ), sizes AS (
            SELECT doc_id, len(words) AS n_words, sum(len(words)) OVER () - len(words) AS others FROM listed
        ), scored AS (
            SELECT p.doc_id,
                   CASE WHEN t.n > 0 THEN ln(t.n / c.n)
                        ELSE ln(CASE WHEN p.before IS NULL THEN 1 ELSE 0.4 END)
                             + CASE WHEN w.n > 0 THEN ln(w.n / s.others) ELSE ln(0.4 / s.others) END
                   END AS score
            FROM pairs p
            JOIN sizes s ON s.doc_id = p.doc_id
            JOIN one_left w ON w.doc_id = p.doc_id AND w.word = p.word
            LEFT JOIN one_left c ON c.doc_id = p.doc_id AND c.word = p.before
            LEFT JOIN two_left t ON t.doc_id = p.doc_id AND t.before = p.before AND t.word = p.word
        ), means AS (
            SELECT doc_id, round(avg(score), 6) AS score FROM scored GROUP BY doc_id
        )
        SELECT s.doc_id, s.n_words, m.score FROM sizes s LEFT JOIN means m USING (doc_id)
    """,
    "op10_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_importance_resampling": f"""
        WITH texts AS (
            SELECT true AS is_doc, row_number() OVER () AS line, doc_id, text FROM documents
            UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark
        ), listed AS (
            SELECT is_doc, line, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM texts
        ), counted AS (
            SELECT is_doc, line, word, count(*) AS n
            FROM (SELECT is_doc, line, unnest(words) AS word FROM listed) GROUP BY ALL
        ), crc_steps AS ({CRC_TABLE}
        ), placed AS (
            SELECT word, {CRC} % 10000 AS bucket
            FROM (SELECT DISTINCT word, hex(word) AS digits FROM counted), crc_steps
        ), buckets AS (
            SELECT range AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
            FROM range(10000) LEFT JOIN (
                SELECT bucket, sum(n) FILTER (is_doc) AS s, sum(n) FILTER (NOT is_doc) AS t
                FROM counted JOIN placed USING (word) GROUP BY bucket
            ) ON range = bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)
                                           / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS gain
            FROM buckets
        ), weights AS (
            SELECT line, sum(n * gain)::BIGINT AS weight
            FROM counted JOIN placed USING (word) JOIN gains USING (bucket) WHERE is_doc GROUP BY line
        ), scored AS (
            SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM listed LEFT JOIN weights USING (line) WHERE is_doc
        ), places AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER (PARTITION BY n_features >= 20) AS able
            FROM scored
        )
        SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
        FROM places
    """,
    "op13_sharding": f"""
        WITH crc_steps AS ({CRC_TABLE}
        ), sized AS (
            SELECT row_number() OVER () AS line, doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(coalesce(text, '')) AS digits
            FROM documents
        ), measured AS (
            SELECT line, doc_id, size, coalesce({CRC}, 0) AS text_crc32 FROM sized, crc_steps
        ), drawn AS (
            SELECT line, shard, ('0x' || md5(doc_id || ':' || shard)[1:13])::BIGINT AS draw
            FROM measured, (SELECT unnest(range(9))::INTEGER AS shard)
        ), won AS (
            SELECT line, arg_max(shard, draw) FILTER (shard < 8) AS shard, arg_max(shard, draw) AS grown_shard
            FROM drawn GROUP BY line
        ), parted AS (
            SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // 1000 AS part
            FROM measured JOIN won USING (line)
        ), placed AS (
            SELECT *, ('0x' || md5(doc_id || ':' || size || ':' || text_crc32 || ':' || part)[1:13])::BIGINT AS place FROM parted
        )
        SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY place, doc_id, size, text_crc32, part) - 1 AS slot, grown_shard
        FROM placed
    """,
}

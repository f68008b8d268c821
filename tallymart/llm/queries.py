"""One query for each operator over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import (
    conversations,
    distinct_words,
    exact_dedup,
    huffman_files,
    licenses,
    near_dedup,
    packing,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from tallymart.llm.shared import BYTE_TOKENIZER, WORD_TOKENIZER, load, tokenizer_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op3_distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_words.encode_digests(load(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(load(spark, sf_dir, "documents"))


def op5_huffman_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman_files.round_trip(load(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(load(spark, sf_dir, "documents"), length=400)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(load(spark, sf_dir, "documents"), width=3, percent=85)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality.judge_quality(docs, quality.fit_quality(docs, load(spark, sf_dir, "labels")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.grade_toxicity(docs, toxicity.fit_toxicity(docs, load(spark, sf_dir, "labels")))


def op11_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digests(load(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(load(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "conversations")
    return conversations.repair_digests(conversations.damaged(table), table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_packing,
        op3_distinct_words,
        op4_licenses,
        op5_huffman_files,
        op6_suffix_dedup,
        op7_near_dedup,
        op8_exact_dedup,
        op9_quality,
        op10_toxicity,
        op11_warc_revisits,
        op12_whitening,
        op13_conversation_repair,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_warc_revisits": """
        WITH hashed AS (
            SELECT page_id, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
            FROM pages
        ), resolved AS (
            SELECT page_id, payload_bytes, digest, min(page_id) OVER (PARTITION BY digest) AS first_id FROM hashed
        )
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
                   (CAST('0x' || substr(digest, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT)
                    >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM resolved
    """,
}

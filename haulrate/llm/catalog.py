"""The registered queries of the operators, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from haulrate.llm import (
    alignment,
    exact_dedup,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_model,
    packing,
    pieces,
    quality,
    secret_scan,
    slack_packing,
    toxicity,
    url_filter,
)
from haulrate.llm.common import documents, table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_rows(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(documents(spark, sf_dir), public_tokenizers.path(PIECE_MODEL))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.perplexities(documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op11_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    return slack_packing.pack(documents(spark, sf_dir), path)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in (BYTE_TOKENIZER, PIECE_MODEL))
    return alignment.alignment(documents(spark, sf_dir), *paths)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_url_filters": op4_url_filters,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scans": op9_secret_scans,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_slack_packing": op11_slack_packing,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

ORACLE_SQL = {
    "op1_exact_dedup": f"""
        WITH digested AS (
            SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents
        ), middle AS (
            SELECT (min(doc_id) + max(doc_id)) // 2 AS id FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
            doc_id = max(doc_id) OVER g AS kept, text_sha256,
            min(doc_id) OVER g <= (SELECT id FROM middle) AS in_history
        FROM digested WINDOW g AS (PARTITION BY text_sha256)
    """,
}

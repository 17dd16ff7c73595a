"""The registered queries of the operators in this folder. Each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civiclake.llm import (
    alignment, bpe, divergence, fingerprints, langid, licenses, mixing, pieces, secrets, simhash, substrings, token_counts, topk,
)
from civiclake.llm.common import table


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.result(table(spark, sf_dir, "documents"))


def op2_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.result(table(spark, sf_dir, "embeddings"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.result(table(spark, sf_dir, "documents"))


def op4_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.result(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.result(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.result(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.result(table(spark, sf_dir, "documents"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.result(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.result(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.result(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.result(table(spark, sf_dir, "documents"))


def op12_sentencepiece_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.result(table(spark, sf_dir, "documents"))


def op13_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.result(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = [
        op1_license_scans, op2_exact_top_k_search, op3_secret_scans, op4_bpe_encoding_and_decoding, op5_mixing,
        op6_token_counts, op7_language_id, op8_document_fingerprints, op9_substring_dedup, op10_simhash_near_dedup,
        op11_cross_tokenizer_alignment, op12_sentencepiece_encoding_and_decoding, op13_source_divergence_audit,
    ]
    return {query.__name__: query for query in chosen}


def all_oracles() -> dict[str, str]:
    return {
        "op1_license_scans": licenses.oracle(), "op2_exact_top_k_search": topk.oracle(), "op5_mixing": mixing.oracle(),
        "op9_substring_dedup": substrings.oracle(), "op13_source_divergence_audit": divergence.oracle(),
    }

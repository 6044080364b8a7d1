"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import (exact_search, hard_negatives, language_id, license_scan, line_dedup, merkle, mixing, near_dedup, packing,
                         quality_rules, substring_dedup, token_counts, token_records)
from kestrel.session import prepare
from kestrel.sources.tables import read_table

CONTRACT_SHINGLE_WORDS = 4  # the registered query's; the operator's default is five

Query = Callable[[SparkSession, str], DataFrame]


def _documents(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_table(prepare(spark), sf_dir, "documents"))
    return run


def _embeddings(fn: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_table(prepare(spark), sf_dir, "embeddings"))
    return run


def queries() -> dict[str, Query]:
    return {
        "op1_exact_top_k": _embeddings(exact_search.top_k),
        "op2_language_id": _documents(language_id.identify),
        "op3_near_dedup": _documents(lambda docs: near_dedup.near_duplicates(docs, size=CONTRACT_SHINGLE_WORDS)),
        "op4_substring_dedup": _documents(substring_dedup.substring_report),
        "op5_mixing": _documents(mixing.mix_report),
        "op6_line_dedup": _documents(line_dedup.line_report),
        "op7_token_records": _documents(token_records.token_report),
        "op8_license_scan": _documents(license_scan.scan),
        "op9_packing": _documents(packing.pack_documents),
        "op10_quality_rules": _documents(quality_rules.quality_report),
        "op11_hard_negatives": _embeddings(hard_negatives.negatives_report),
        "op12_merkle_manifest": _documents(merkle.merkle_report),
        "op13_token_counts": _documents(token_counts.token_counts),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": exact_search.oracle_sql(),
        "op5_mixing": mixing.oracle_sql(),
        "op6_line_dedup": line_dedup.oracle_sql(),
        "op8_license_scan": license_scan.oracle_sql(),
        "op10_quality_rules": quality_rules.oracle_sql(),
        "op11_hard_negatives": hard_negatives.oracle_sql(),
        "op12_merkle_manifest": merkle.oracle_sql(),
    }

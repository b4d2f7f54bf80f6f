"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobmine.llm import (
    decontamination, exact_dedup, fingerprints, hard_negatives, katz, language_id, license_scan, merkle, near_dedup,
    packing, quality, quote_links, suffix_dedup,
)
from jobmine.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op5(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op6(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.op4(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.op12(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_katz_backoff": _over_documents(katz.op1),
    "op2_rank_profiles": _over_documents(language_id.op2),
    "op3_best_fit_packing": _over_documents(packing.op3),
    "op4_quote_links": _quotes,
    "op5_spaced_seeds": _decontaminate,
    "op6_quadratic_quality": _quality,
    "op7_exact_dedup": _over_documents(exact_dedup.op7),
    "op8_license_diagonals": _over_documents(license_scan.op8),
    "op9_near_dedup": _over_documents(near_dedup.op9),
    "op10_suffix_levels": _over_documents(suffix_dedup.op10),
    "op11_multiset_fingerprints": _over_documents(fingerprints.op11),
    "op12_hard_negatives": _negatives,
    "op13_merkle_manifest": _over_documents(merkle.op13),
}

SQL: dict[str, str] = {
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}

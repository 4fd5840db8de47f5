"""The queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import bpe_automaton, fingerprints, html_extract, ngram_join, packing, quality_rules, secret_scan, substring_dedup, token_counts, token_files
from gleanery.llm.tokenizing import tokenizer_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, size=1024)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(_table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.maintained_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), "byte_bpe_50k")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe_round_trip, op2_substring_dedup, op3_ngram_jaccard_join, op4_quality_rules, op5_secret_scans, op6_best_fit_packing, op7_html_extraction, op8_token_counts, op9_token_files, op10_fingerprints)}


def oracle_sql() -> dict[str, str]:
    return {}

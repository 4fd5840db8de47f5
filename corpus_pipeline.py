"""The corpus pipeline: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import ngram_join, packing, quality_rules, secret_scan, shared, substring_dedup
from gleanery.llm.tokenizing import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links: the one with the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that another one keeps."""
    return substring_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced by a mark."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.best_fit_packing(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2, size=1024)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", repeated_passages), ("secret_scans", secrets), ("best_fit_packing", packed)]

#: A random field, tokenizers and bin packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

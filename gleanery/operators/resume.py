"""Incremental runs over tables: what is new, what is marked, how results are put together and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.columns import spare

#: What a row of a classifier's run may be.
STATUSES = ("processed", "error", "duplicate", "resumed")


def unprocessed(df: DataFrame, prior: DataFrame, key: str, prior_key: str | None = None) -> DataFrame:
    """Rows of df whose key the prior results don't have; df keeps its duplicates and null keys."""
    name = spare("_done", df)
    done = prior.select(F.col(prior_key or key).alias(name)).where(F.col(name).isNotNull()).distinct()
    return df.join(done, F.col(key) == F.col(name), "left_anti")


def mark_seen(df: DataFrame, checkpoint: DataFrame, key: str, name: str = "seen") -> DataFrame:
    """df with a flag: whether the checkpoint has the key. Rows stay."""
    mark = spare("_done", df)
    done = checkpoint.select(F.col(key).alias(mark)).where(F.col(mark).isNotNull()).distinct()
    return df.join(done, F.col(key) == F.col(mark), "left").withColumn(name, F.col(mark).isNotNull()).drop(mark)


def status(error: Column, is_duplicate: Column, seen: Column) -> Column:
    """One of STATUSES. A copy of an unreadable file is a duplicate; what an earlier run has done is resumed."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(seen), F.lit("resumed")).when(yes(is_duplicate), F.lit("duplicate")).when(error.isNotNull(), F.lit("error")).otherwise(F.lit("processed"))


def union_append(prior: DataFrame, new: DataFrame) -> DataFrame:
    """Both, by column name, with nothing removed."""
    return prior.unionByName(new, allowMissingColumns=True)


def merged_status_rows(predicted: DataFrame, *others: DataFrame) -> DataFrame:
    """Predictions and status rows as one table; a table has no order, so order by status and path where it matters."""
    out = predicted
    for df in others:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def run_counters(df: DataFrame, column: str = "status") -> DataFrame:
    """Processed, errors, duplicates and skipped, in one row."""
    count = lambda value: F.count_if(F.coalesce(F.col(column) == value, F.lit(False)))
    return df.agg(count("processed").alias("processed"), count("error").alias("errors"), count("duplicate").alias("duplicates"), count("resumed").alias("skipped"))


def metrics_report(batches: DataFrame) -> DataFrame:
    """batches: batch_size, inference_s, io_s. Totals, items a second and average milliseconds; no rows for no batches."""
    total = F.sum("inference_s") + F.sum("io_s")
    out = batches.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("batch_size").alias("n_items"),
        F.when(total > 0, F.sum("batch_size") / total).alias("items_per_s"),
        (F.avg("inference_s") * 1000).alias("avg_inference_ms"),
        (F.avg("io_s") * 1000).alias("avg_io_ms"),
    )
    return out.where("n_batches > 0")

"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """df after checkpoint(), in the folder of spark.checkpoint.dir; a local master without that setting gets a temporary one."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="gleanery-checkpoint-"))
    return df.checkpoint()

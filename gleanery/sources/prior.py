"""Earlier results: what a run goes on from."""

from __future__ import annotations

import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

EMBEDDINGS = "image_path string, embedding_dim int, embedding array<float>"
CAPTIONS = "image string, prediction string, analysis_time_sec double, tokens_per_sec double"
PREDICTIONS = "path string, nsfw_score double, safe_score double, inference_ms double, error string"
CHECKPOINT = "file_hash string, path string"

log = logging.getLogger(__name__)


class PriorResultError(ValueError):
    """An earlier result that isn't an array of records; it is not overwritten."""


def read_prior_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of a JSON array file, with a declared schema. A missing file has none; an unreadable one has none, with a
    warning; one that holds something else than an array raises PriorResultError."""
    if not os.path.exists(path):
        return spark.createDataFrame([], schema)
    try:
        with open(path, encoding="utf-8") as f:
            head = f.read(4096).lstrip()
            if not head.startswith("["):
                json.loads(head + f.read())
                raise PriorResultError(f"{path} holds no array of records")
    except (json.JSONDecodeError, UnicodeDecodeError) as e:
        log.warning("%s can't be read and counts as empty: %s", path, e)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_checkpoint(spark: SparkSession, path: str, resume: bool = True) -> DataFrame:
    """file_hash and path of what an earlier run has done; nothing if there is none, or if the run isn't to resume."""
    if not resume:
        return spark.createDataFrame([], CHECKPOINT)
    try:
        return spark.read.schema(CHECKPOINT).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], CHECKPOINT)

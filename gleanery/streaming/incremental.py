"""Incremental runs: a stream of files or tables, processed once each.

The stream's checkpoint knows which files were read; the state of the dropped duplicates knows every content hash ever seen.
There is no event time here, so nothing bounds that state: give a fresh checkpoint to begin anew.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, glob: str = "*", files_per_batch: int = 64) -> DataFrame:
    """path, modificationTime, length and content of the files of a folder, as they come."""
    return spark.readStream.format("binaryFile").schema(spark.read.format("binaryFile").load(path).schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(path)


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_content(stream: DataFrame, content: str = "content") -> DataFrame:
    """Rows whose content hasn't come before, in this run or an earlier one with the same checkpoint."""
    return stream.withColumn("file_hash", F.md5(F.col(content).cast("binary"))).dropDuplicates(["file_hash"])


def run_available(rows: DataFrame, out: str, checkpoint: str, each_batch: Callable[[DataFrame, int], DataFrame] | None = None) -> StreamingQuery:
    """Processes what is there now in micro-batches and stops; a later run with the same checkpoint goes on from there.

    each_batch turns a batch into its result rows. A batch that is repeated after a failure replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        result = each_batch(batch, number) if each_batch else batch
        result.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stop_gracefully(query: StreamingQuery, requested: threading.Event, every: float = 0.5) -> None:
    """Waits for the query; once a stop is requested, lets the batch in hand end and stops."""
    while query.isActive and not requested.is_set():
        query.awaitTermination(every)
    while query.isActive and query.status["isTriggerActive"]:
        query.awaitTermination(every)
    query.stop()

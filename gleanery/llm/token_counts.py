"""Token counts: delta-maintained rollups.

A batch is a table of signed changes: an insert adds a document's count, a delete takes it away, and a revised count takes
the old one away and adds the new. Changes are summed by source, language and tokenizer version before anything moves, so a
batch is a few rows a task, whatever share of the rows one source holds. The sums are the batch's delta; totals are the
sum of all deltas, which are additive and may be put together at any time.

Commits are idempotent: a batch has an id, its delta is written to a folder of that name in one job, and a batch whose
folder is whole is never written again. A half-written folder, left by a lost driver, is written anew.

Defined cases: a null text has no tokens; null sources, languages and versions are groups of their own; repeated rows count
as often as they come; other columns are ignored; an empty batch commits an empty delta; totals of zero documents and zero
tokens are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.tokenizing import encoder

KEYS = ["source", "lang", "tokenizer_version"]
DELTA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


class Rollup:
    """Totals in a folder, maintained by signed changes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _exists(self, name: str) -> bool:
        path = self._path(name)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch: KEYS, sign (1 or -1) and n_tokens for each change. False if the batch was committed before."""
        if self._exists(f"batch={batch_id}/_SUCCESS"):
            return False
        delta = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
        delta.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
        return True

    def totals(self) -> DataFrame:
        """KEYS, n_docs and n_tokens over all committed batches."""
        names = self._committed()
        if not names:
            return self.spark.createDataFrame([], DELTA)
        deltas = self.spark.read.schema(DELTA).parquet(*(f"{self.folder}/{n}" for n in names))
        return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def _committed(self) -> list[str]:
        top = self._path("")
        files = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(top):
            return []
        names = [s.getPath().getName() for s in files.listStatus(top)]
        return sorted(n for n in names if n.startswith("batch=") and self._exists(f"{n}/_SUCCESS"))


def counted(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """doc_id, source, lang, tokenizer_version, n_tokens, and n_words as the first estimate, of each document; digest tells equal texts."""
    shared.ship(docs.sparkSession)
    ddl = "doc_id long, source string, lang string, n_tokens long, n_words long, digest string"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        schema = shared.schema_of(ddl)
        for batch in shared.slices(batches, "text"):
            texts = shared.texts_of(batch)
            tokens = [len(x) // 4 for x in encoder(tokenizer).encode(texts)]
            raw = [x.encode("utf-8") for x in texts]
            columns = {c: batch.column(c) for c in ("doc_id", "source", "lang")} | {"n_tokens": tokens, "n_words": [len(x.split()) for x in raw], "digest": [xxhash.xxh3_128_hexdigest(x) for x in raw]}
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    columns = [docs["doc_id"].cast("long").alias("doc_id"), *(docs[c].cast("string").alias(c) for c in ("source", "lang", "text"))]
    return docs.select(*columns).mapInArrow(count, ddl).withColumn("tokenizer_version", F.lit(version))


def change(rows: DataFrame, n_tokens: str, sign: int) -> DataFrame:
    return rows.select(*KEYS, F.lit(sign).alias("sign"), F.col(n_tokens).alias("n_tokens"))


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows whose text an earlier doc_id has too. Copies are found by their digest; first copies by a pre-aggregated minimum."""
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("first_doc_id")).where("n_copies > 1")
    return shared.join_groups(rows, groups, "digest", "n_copies", rows.count()).where("doc_id > first_doc_id")


def maintained_counts(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """Totals by KEYS after three batches: all documents with an estimate (their words), the revised counts of the tokenizer, and the deletion of exact copies.

    The second batch is sent twice, as a lost acknowledgement would have it, and counts once.
    """
    spark = docs.sparkSession
    rows = shared.written(counted(docs, tokenizer, version), "counted")
    rollup = Rollup(spark, shared.fresh(spark, "rollup"))
    rollup.commit("0001", change(rows, "n_words", 1))
    revised = change(rows, "n_words", -1).unionByName(change(rows, "n_tokens", 1))
    rollup.commit("0002", revised)
    rollup.commit("0002", revised)
    rollup.commit("0003", change(later_copies(rows), "n_tokens", -1))
    return rollup.totals()

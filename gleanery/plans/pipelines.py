"""The programs as plans: each lists files, leaves out what is done, and gives a DataFrame for a sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.durable import durable
from gleanery.functions import hashing, pixels
from gleanery.operators import dedup, models, naming, palette, resume
from gleanery.sources import listing, prior


@dataclass(frozen=True)
class ClassifyConfig:
    path: str
    checkpoint: str | None = None
    resume: bool = True
    drop_duplicates: bool = True
    batch_size: int | None = 16
    most_side: int = 1024


def embed(spark: SparkSession, path: str, make: Callable[[], models.Backend], prior_path: str | None = None, most_side: int = 384) -> DataFrame:
    """Earlier embeddings and those of new files, by path."""
    files = listing.scan_recursive(spark, path, listing.EMBED)
    done = prior.read_prior_json(spark, prior_path, prior.EMBEDDINGS) if prior_path else spark.createDataFrame([], prior.EMBEDDINGS)
    new = resume.unprocessed(files, done, "path", "image_path")
    rows = models.embed(listing.read_bytes(new.select("path")), make, most_side=most_side)
    return resume.union_append(done, rows.select(F.col("path").alias("image_path"), "embedding_dim", "embedding"))


def _hashes(contents):
    def one(content):
        try:
            return hashing.perceptual_hash(pixels.on_white(pixels.decode(bytes(content or b""))))
        except ValueError:
            return None

    return contents.map(one).astype("Int64")


def near_duplicates(spark: SparkSession, path: str, make: Callable[[], models.Backend], hash_distance: int = dedup.HASH_DISTANCE, cosine: float = dedup.COSINE_DISTANCE) -> DataFrame:
    """group_id, rank, path, name, size of near-duplicate images; files that can't be decoded are left out.

    The model runs on the candidates of the hash stage only.
    """
    files = listing.read_bytes(listing.scan_flat(spark, path).select("path", "name", "size"))
    hashed = files.withColumn("phash", F.pandas_udf(_hashes, "long")("content")).drop("content", "error").where("phash is not null")
    numbered = naming.global_serial(hashed, ["path"], "id")

    def vectors(candidates: DataFrame) -> DataFrame:
        found = models.embed(listing.read_bytes(candidates.select("path")), make, most_side=0, normalize=True, on_error="row")
        return candidates.join(found.select("path", F.col("embedding").alias("vector")), "path", "left")

    groups = dedup.near_duplicate_groups(numbered, hash_distance, cosine, vectors=vectors)
    return dedup.keep_rank(groups).select("group_id", "rank", "path", "name", "size")


def classify(spark: SparkSession, config: ClassifyConfig, make: Callable[[], models.Backend]) -> DataFrame:
    """path, status, scores, inference_ms, error and file_hash of each file; the model runs on new and readable content only."""
    files = durable(listing.read_bytes(listing.scan_file_or_dir(spark, config.path).select("path")).withColumn("file_hash", hashing.blake2b_128(F.col("content"))))
    done = prior.read_checkpoint(spark, config.checkpoint, config.resume) if config.checkpoint else spark.createDataFrame([], prior.CHECKPOINT)
    marked = resume.mark_seen(files, done, "file_hash")
    marked = dedup.first_wins(marked, "file_hash", ["path"]) if config.drop_duplicates else marked.withColumn("is_duplicate", F.lit(False))
    marked = marked.withColumn("status", resume.status(F.col("error"), F.col("is_duplicate") & F.col("content").isNotNull(), F.col("seen")))
    todo = marked.where("status = 'processed'")
    scored = models.prediction_rows(models.classify(todo, make, config.batch_size, config.most_side)).join(todo.select("path", "file_hash"), "path")
    scored = scored.withColumn("status", F.when(F.col("error").isNull(), F.lit("processed")).otherwise(F.lit("error")))
    return resume.merged_status_rows(scored, marked.where("status <> 'processed'").select("path", "file_hash", "status", "error"))


def captions(spark: SparkSession, path: str, make: Callable[[], models.Backend], prompt: str, prior_path: str | None = None, suffixes: str | None = None, batch_size: int = 1, lowercase: bool = False) -> DataFrame:
    files = listing.scan_sorted(spark, path, listing.parse_suffixes(suffixes) if suffixes else listing.CAPTION)
    done = prior.read_prior_json(spark, prior_path, prior.CAPTIONS) if prior_path else spark.createDataFrame([], prior.CAPTIONS)
    new = resume.unprocessed(files, done, "path", "image")
    rows = models.caption(listing.read_bytes(new.select("path")), make, prompt, batch_size, lowercase=lowercase)
    return resume.union_append(done, rows)


def palettes(spark: SparkSession, path: str) -> DataFrame:
    return palette.palettes(listing.read_bytes(listing.scan_file_any_suffix(spark, path).select("path")))


def serial_rename(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The plan for apply.convert_and_move."""
    everything = listing.listing(spark, path, recursive=True).select("dir", "name")
    existing = everything.where(naming.in_backup_dir(F.col("dir")))
    return naming.backup_names(naming.serial_rename_plan(listing.scan_for_serial(spark, path, recursive)), existing)


def hash_rename(spark: SparkSession, path: str) -> DataFrame:
    """The plan for apply.rename."""
    files = listing.read_bytes(listing.scan_flat_files(spark, path)).where("error is null")
    return naming.hash_rename_plan(files.withColumn("hash", hashing.md5_hex(F.col("content"))).drop("content", "error"))

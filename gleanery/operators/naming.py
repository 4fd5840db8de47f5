"""Rename plans: what a file would be called. Nothing here touches a file; see gleanery.sinks.apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.columns import spare
from gleanery.durable import durable
from gleanery.functions import text
from gleanery.operators.ranking import free_numbers, global_serial, rank_within

#: The backup folder's name, and the names that a serial rename has given.
BACKUP_DIR = "___!ORIGINAL_IMAGE"
ALREADY_NAMED = r"(?i)^\p{Nd}+_\p{Nd}{7}\.jpg$"


def already_named(name: Column) -> Column:
    return name.rlike(ALREADY_NAMED)


def in_backup_dir(directory: Column) -> Column:
    return F.array_contains(F.split(directory, "/"), BACKUP_DIR)


def serial_rename_plan(files: DataFrame) -> DataFrame:
    """files (the listing) that aren't named already and aren't backups, with serial, new_name, new_path and backup_dir.

    Serial numbers go by time over all folders, ties by path. Over 9,999,999 a name has more digits and counts as new again.
    """
    new = files.where(~already_named(F.col("name")) & ~in_backup_dir(F.col("dir")))
    named = global_serial(new, ["ctime", "path"]).withColumn("new_name", text.serial_name(F.col("ctime"), F.col("serial")))
    return named.withColumn("new_path", F.concat_ws("/", "dir", "new_name")).withColumn("backup_dir", F.concat_ws("/", "dir", F.lit(BACKUP_DIR)))


def hash_rename_plan(files: DataFrame, hash_column: str = "hash", within: list[str] | None = None) -> DataFrame:
    """files with new_name: hash.ext for one file, hash_duplicate.ext and hash_duplicate_1.ext and so on for its copies.

    A file that has a right name for its hash keeps it, so the plan of a renamed folder changes nothing. The others fill the
    free places by path. Extensions keep their case, and differ by it. within: further columns that names are unique in.
    A file without a hash has no new name.
    """
    ext, at, number = (spare(x, files) for x in ("_ext", "_place", "_number"))
    h = F.col(hash_column)
    rest = F.substr(text.stem(F.col("name")), F.length(h) + 1)
    canonical = F.startswith(F.col("name"), h) & ((rest == "") | rest.rlike(r"^_duplicate(_[1-9][0-9]*)?$"))
    place = F.when(rest == "", 0).when(rest == "_duplicate", 1).otherwise(F.regexp_extract(rest, r"_duplicate_(\d+)$", 1).cast("long") + 1)
    key = [*(within or []), hash_column, ext]
    marked = durable(files.withColumn(ext, text.suffix(F.col("name"))).withColumn(at, F.when(canonical, place).cast("long")))
    kept = marked.where(F.col(at).isNotNull())
    moved = free_numbers(marked.where(F.col(at).isNull()), key, ["path"], kept.select(*key, (F.col(at) + 1).alias("number")), number)
    placed = kept.unionByName(moved.withColumn(at, F.col(number) - 1).drop(number))
    tail = F.when(F.col(at) == 0, F.lit("")).when(F.col(at) == 1, F.lit("_duplicate")).otherwise(F.concat(F.lit("_duplicate_"), (F.col(at) - 1).cast("string")))
    return placed.withColumn("new_name", F.concat(h, tail, ext)).drop(ext, at)


def changed_names(plan: DataFrame) -> DataFrame:
    return plan.where("new_name <> name")


def backup_names(plan: DataFrame, existing: DataFrame | None = None, order: list[str] | None = None) -> DataFrame:
    """plan with backup_name, which no file of the backup folder (existing: dir, name) and no other row of the plan has.

    Of the rows with one name in a folder the first by the order (path, if there is one) keeps it, unless a file has it; the
    others get base_1.ext, base_2.ext and so on, leaving out the numbers that files or old names of the plan have.
    """
    keys = ["backup_dir", "name"]
    order = (["path"] if "path" in plan.columns else []) if order is None else order
    kind, rank, number = (spare(x, plan) for x in ("_is_plan", "_rank", "_number"))
    plan = durable(plan)
    names = plan.select(*keys)
    held = (names.where("false") if existing is None else existing.select(F.col("dir").alias(keys[0]), "name")).distinct()
    both = plan.withColumn(kind, F.lit(1)).unionByName(held.withColumn(kind, F.lit(0)), allowMissingColumns=True)
    ranked = rank_within(both, keys, [kind, *order], rank).where(F.col(kind) == 1).drop(kind)
    base, ext = text.stem(F.col("name")), text.suffix(F.col("name"))
    tail = r"_([1-9][0-9]{0,17})$"
    numbered = held.union(names).distinct().where(base.rlike(tail))
    taken = numbered.select(keys[0], F.concat(F.regexp_replace(base, tail, ""), ext).alias("name"), F.regexp_extract(base, tail, 1).cast("long").alias("number"))
    kept = ranked.where(F.col(rank) == 1).drop(rank).withColumn("backup_name", F.col("name"))
    moved = free_numbers(ranked.where(F.col(rank) > 1).drop(rank), keys, order, taken, number)
    return kept.unionByName(moved.withColumn("backup_name", F.concat(base, F.lit("_"), F.col(number).cast("string"), ext)).drop(number))

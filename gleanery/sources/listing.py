"""File listings as a data source, and the bytes of listed files.

Spark's own file sources leave out names that begin with _ or ., match suffixes by case and know no change time; this one
lists every regular file with its change time. It lists folders that the driver and the executors can see under one path;
for object stores use format("binaryFile"), see bytes_of.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gleanery.shipping import ship

LISTING = "path string, name string, dir string, ext string, size bigint, ctime double"

# The suffixes that each program takes.
EMBED = (".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tiff")
NEAR_DUPLICATE = (".jpg", ".jpeg", ".png", ".bmp", ".gif", ".tiff", ".webp")
CLASSIFY = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".tiff")
CAPTION = (".jpg", ".jpeg", ".png", ".bmp", ".gif", ".webp", ".tiff", ".tif")
PALETTE = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".tiff")
SERIAL_RENAME = (".jpg", ".jpeg", ".png", ".webp", ".avif")
HASH_RENAME = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp")


@dataclass
class Folder(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, root: str, recursive: bool, pruned: tuple[str, ...]):
        self.root, self.recursive, self.pruned = root, recursive, pruned

    def partitions(self) -> list[InputPartition]:
        """A partition for each folder right below the root, which its task walks, and one for the root's own files."""
        if os.path.isfile(self.root):
            return [Folder(self.root)]
        below = [e.path for e in os.scandir(self.root) if e.is_dir(follow_symlinks=False) and e.name not in self.pruned] if self.recursive else []
        return [Folder(self.root), *map(Folder, sorted(below))]

    def read(self, partition: Folder) -> Iterator[tuple]:
        if os.path.isfile(partition.path):
            yield self._row(partition.path)
            return
        for folder, below, files in os.walk(partition.path):
            below[:] = sorted(d for d in below if d not in self.pruned)
            if partition.path == self.root:
                below.clear()
            for name in sorted(files):
                path = os.path.join(folder, name)
                if os.path.isfile(path):
                    try:
                        yield self._row(path)
                    except FileNotFoundError:  # gone since it was listed
                        continue

    def _row(self, path: str) -> tuple:
        folder, name = os.path.split(path)
        found = os.stat(path)
        return path, name, folder, os.path.splitext(name)[1], found.st_size, found.st_ctime


class FileListing(DataSource):
    """format("gleanery_files"): options path, recursive (true) and prune (folder names, comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return "gleanery_files"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        root = os.path.abspath(self.options["path"])
        if not os.path.exists(root):
            raise FileNotFoundError(root)
        pruned = tuple(x for x in self.options.get("prune", "").split(",") if x)
        return _Reader(root, self.options.get("recursive", "true").lower() == "true", pruned)


def listing(spark: SparkSession, path: str, recursive: bool = True, prune: tuple[str, ...] = ()) -> DataFrame:
    ship(spark)
    spark.dataSource.register(FileListing)
    return spark.read.format("gleanery_files").options(path=path, recursive=str(recursive).lower(), prune=",".join(prune)).load()


def with_suffix(files: DataFrame, suffixes: tuple[str, ...], bare: bool = False) -> DataFrame:
    """Files whose suffix is one of these in any case. bare: a file named just ".jpg" counts too, as for a plain end of name."""
    if bare:
        return files.where(F.lower("name").rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"))
    return files.where(F.lower("ext").isin(*suffixes))


def scan_recursive(spark: SparkSession, path: str, suffixes: tuple[str, ...] = EMBED) -> DataFrame:
    return with_suffix(listing(spark, path), suffixes)


def scan_flat(spark: SparkSession, path: str, suffixes: tuple[str, ...] = NEAR_DUPLICATE) -> DataFrame:
    return with_suffix(listing(spark, path, recursive=False), suffixes, bare=True)


def scan_sorted(spark: SparkSession, path: str, suffixes: tuple[str, ...] = CAPTION) -> DataFrame:
    return scan_recursive(spark, path, suffixes).orderBy("path")


def scan_file_or_dir(spark: SparkSession, path: str, suffixes: tuple[str, ...] = CLASSIFY) -> DataFrame:
    """A file if its suffix is right, else nothing; of a folder all files below it."""
    return scan_recursive(spark, path, suffixes)


def scan_file_any_suffix(spark: SparkSession, path: str, suffixes: tuple[str, ...] = PALETTE) -> DataFrame:
    """A file whatever its suffix; of a folder its own files."""
    if os.path.isfile(path):
        return listing(spark, path)
    return scan_flat(spark, path, suffixes)


def scan_for_serial(spark: SparkSession, path: str, recursive: bool = False, suffixes: tuple[str, ...] = SERIAL_RENAME) -> DataFrame:
    """Files to be numbered: not in a backup folder, and not numbered already."""
    from gleanery.operators.naming import BACKUP_DIR, already_named

    return with_suffix(listing(spark, path, recursive, (BACKUP_DIR,)), suffixes, bare=True).where(~already_named(F.col("name")))


def scan_flat_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = HASH_RENAME) -> DataFrame:
    return with_suffix(listing(spark, path, recursive=False), suffixes)


def parse_suffixes(text: str) -> tuple[str, ...]:
    """Comma-separated suffixes, with or without a dot, in any case and with spaces around."""
    parts = [x.strip().lower() for x in text.split(",")]
    return tuple(x if x.startswith(".") else f".{x}" for x in parts if x)


def read_bytes(files: DataFrame) -> DataFrame:
    """files with content and error; the bytes are read where they are used, a file at a time.

    The listing of a folder is one partition, so its rows are dealt out before their bytes are read.
    """
    columns = files.columns

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 16):
                part = frame.iloc[start : start + 16]
                contents, errors = [], []
                for path in part["path"]:
                    try:
                        with open(path, "rb") as f:
                            contents.append(f.read())
                        errors.append(None)
                    except OSError as e:
                        contents.append(None)
                        errors.append(str(e))
                yield part[columns].assign(content=contents, error=errors)

    spark = files.sparkSession
    ship(spark)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema)
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(read, f"{fields}, content binary, error string")


def bytes_of(spark: SparkSession, path: str, suffixes: tuple[str, ...]) -> DataFrame:
    """path, size and content of files in any store that Spark reads; names that begin with _ or . are left out there."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ends = F.lower(name).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$")
    return found.where(ends).select("path", F.col("length").alias("size"), "content")


def decoded_images(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height, channels and RGB bytes of the formats that the JVM decodes; undecodable files have an error."""
    rows = spark.read.format("image").option("recursiveFileLookup", "true").load(path)

    def rgb(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for frame in frames:
            out = []
            for origin, width, height, n, data in zip(*(frame[c] for c in ("origin", "width", "height", "nChannels", "data")), strict=True):
                uri = unquote(origin)
                if width < 0:
                    out.append((uri, None, None, None, None, "undecodable image"))
                    continue
                array = np.frombuffer(data, np.uint8).reshape(height, width, n)
                array = array if n == 1 else np.concatenate([array[..., 2::-1], array[..., 3:]], axis=2)  # stored as BGR
                out.append((uri, width, height, n, array.tobytes(), None))
            yield pd.DataFrame(out, columns=["path", "width", "height", "channels", "data", "error"]).astype({c: "Int32" for c in ("width", "height", "channels")})

    ship(spark)
    return rows.select("image.*").drop("mode").mapInPandas(rgb, "path string, width int, height int, channels int, data binary, error string")

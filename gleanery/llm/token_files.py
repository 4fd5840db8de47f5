"""Token-ID files: bit-plane shuffling.

A file holds the ids of a range of documents in order, each with its end id. Ids are cut into blocks of a fixed size; a
block is transposed into bit planes (or byte planes), each compressed by zstandard on its own, so that the planes of the
high bits, which hardly vary, cost next to nothing.

    file   := magic, block..., index, length of index (8 bytes), magic
    block  := its planes, one after another
    index  := zstandard of: ids in the file, block size, kind of planes, planes in a block (4 x 8 bytes);
              for each block the offsets of its planes and its end (8 bytes each);
              documents (8 bytes), their doc_id, their null flags and their number of ids (8, 1 and 8 bytes each)

All numbers are little-endian. A reader gets any run of ids from the blocks that hold it, which the chunk index locates.

Writing is idempotent: a file is written under a name of the task's attempt and renamed when whole, so a lost or repeated
task leaves one whole file with the same bytes.

Defined cases: a null or empty text is its end id alone; documents with the same doc_id stand in the order of their texts;
a null doc_id sorts first; other columns are ignored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.tokenizing import encoder

MAGIC = b"GLNIDS01"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
MANIFEST = "bucket int, path string, n_docs long, n_ids long, n_bytes long"
BLOCK_IDS = 1 << 16
LEVEL = 1


def planes_of(block: np.ndarray, kind: str) -> list[np.ndarray]:
    """The planes of 32-bit ids: 32 of a bit each, packed, or 4 of a byte each."""
    as_bytes = block.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(as_bytes[:, i]) for i in range(4)]
    return [np.packbits((as_bytes[:, i // 8] >> (i % 8)) & 1, bitorder="little") for i in range(32)]


def block_of(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    out = np.zeros((n, 4), dtype=np.uint8)
    for i, plane in enumerate(planes):
        raw = np.frombuffer(plane, dtype=np.uint8)
        if kind == "byte":
            out[:, i] = raw
        else:
            out[:, i // 8] |= np.unpackbits(raw, count=n, bitorder="little") << (i % 8)
    return out.reshape(-1).view("<u4")


class Writer:
    """Writes ids to a stream, a block at a time; it holds a block, and 17 bytes for each document."""

    def __init__(self, stream, block_ids: int = BLOCK_IDS, kind: str = "byte", level: int = LEVEL):
        import zstandard

        self.stream, self.size, self.kind = stream, block_ids, kind
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.rest = bytearray()
        self.at = stream.write(MAGIC) or len(MAGIC)
        self.offsets: list[int] = []
        self.docs: list[int] = []
        self.nulls = bytearray()
        self.counts: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.rest += ids
        whole = len(self.rest) // (4 * self.size) * 4 * self.size
        for a in range(0, whole, 4 * self.size):
            self._block(self.rest[a : a + 4 * self.size])
        del self.rest[:whole]

    def _block(self, raw: bytes) -> None:
        for plane in planes_of(np.frombuffer(bytes(raw), dtype="<u4"), self.kind):
            packed = self.compressor.compress(plane.tobytes())
            self.offsets.append(self.at)
            self.stream.write(packed)
            self.at += len(packed)
        self.offsets.append(self.at)

    def close(self) -> int:
        """Bytes of the file."""
        if self.rest:
            self._block(bytes(self.rest))
        n_planes = 4 if self.kind == "byte" else 32
        index = struct.pack("<4q", self.n_ids, self.size, n_planes == 4, n_planes) + np.array(self.offsets, "<i8").tobytes()
        index += struct.pack("<q", len(self.docs)) + np.array(self.docs, "<i8").tobytes() + bytes(self.nulls) + np.array(self.counts, "<i8").tobytes()
        packed = self.compressor.compress(index)
        self.stream.write(packed + struct.pack("<q", len(packed)) + MAGIC)
        return self.at + len(packed) + 16


class Reader:
    """Reads a file of ids by its chunk index; holds the index and a block."""

    def __init__(self, file, n_bytes: int):
        import zstandard

        self.file, self.decompressor = file, zstandard.ZstdDecompressor()
        file.seek(n_bytes - 16)
        tail = file.read(16)
        file.seek(0)
        if tail[8:] != MAGIC or file.read(8) != MAGIC:
            raise ValueError("not a whole file of ids")
        (length,) = struct.unpack("<q", tail[:8])
        file.seek(n_bytes - 16 - length)
        index = self.decompressor.decompress(file.read(length))
        self.n_ids, self.size, by_byte, self.n_planes = struct.unpack_from("<4q", index)
        self.kind = "byte" if by_byte else "bit"
        self.n_blocks = -(-self.n_ids // self.size)
        at, n = 32, self.n_blocks * (self.n_planes + 1)
        self.offsets = np.frombuffer(index, "<i8", n, at).reshape(self.n_blocks, self.n_planes + 1)
        at += 8 * n
        (self.n_docs,) = struct.unpack_from("<q", index, at)
        self.docs = np.frombuffer(index, "<i8", self.n_docs, at + 8)
        self.nulls = np.frombuffer(index, np.uint8, self.n_docs, at + 8 + 8 * self.n_docs)
        self.counts = np.frombuffer(index, "<i8", self.n_docs, at + 8 + 9 * self.n_docs)

    def block(self, k: int) -> np.ndarray:
        at = self.offsets[k].tolist()
        self.file.seek(at[0])
        raw = self.file.read(at[-1] - at[0])
        n = min(self.size, self.n_ids - k * self.size)
        return block_of([self.decompressor.decompress(raw[a - at[0] : b - at[0]]) for a, b in zip(at, at[1:], strict=False)], n, self.kind)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end of the file, from the blocks that hold them."""
        blocks = [self.block(k) for k in range(start // self.size, -(-end // self.size))] if end > start else []
        base = start // self.size * self.size
        return np.concatenate(blocks)[start - base : end - base] if blocks else np.zeros(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """doc_id, start in the file and ids of each document, in order, holding a document and a block."""
        rest, k, start = b"", 0, 0
        for doc_id, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.counts.tolist(), strict=True):
            parts, have = [rest], len(rest)
            while have < 4 * n:
                parts.append(self.block(k).tobytes())
                have += len(parts[-1])
                k += 1
            raw = b"".join(parts)
            yield None if null else doc_id, start, raw[: 4 * n]
            rest = raw[4 * n :]
            start += n


def filesystem(uri: str):
    """The file system of a URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, to: str, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS, kind: str = "byte", level: int = LEVEL, n_files: int | None = None) -> DataFrame:
    """Writes the ids of all documents, a file for each range of doc_id; gives MANIFEST, a row for each file."""
    spark = docs.sparkSession
    shared.ship(spark)
    rows = docs.select(shared.long_id(docs, "doc_id").alias("_id"), docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    ranges = shared.Ranges(rows.select("_id"), "_id", n_files or shared.partitions(spark))
    ordered = rows.withColumn("bucket", ranges.of(F.col("_id"))).repartitionById(len(ranges), F.col("bucket")).sortWithinPartitions("_id", "text").select("doc_id", "text", "bucket")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        writer = None
        for batch in shared.slices(batches, "text"):
            if writer is None:
                bucket = batch.column("bucket")[0].as_py()
                files, folder = filesystem(to)
                files.create_dir(folder, recursive=True)
                name = f"{folder}/ids-{bucket:08d}"
                partial = f"{name}.{TaskContext.get().taskAttemptId()}.partial"
                stream = files.open_output_stream(partial)
                writer = Writer(stream, block_ids, kind, level)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer).encode(shared.texts_of(batch)), strict=True):
                writer.add(doc_id, ids + end_id.to_bytes(4, "little"))
        if writer:
            n_bytes = writer.close()
            stream.close()
            files.move(partial, f"{name}.glnids")
            yield pa.RecordBatch.from_pydict({"bucket": [bucket], "path": [f"{to}/ids-{bucket:08d}.glnids"], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids], "n_bytes": [n_bytes]}, schema=shared.schema_of(MANIFEST))

    return ordered.mapInArrow(write, MANIFEST)


def read_files(spark: SparkSession, manifest: list[tuple[int, str, int, int]]) -> DataFrame:
    """RESULT from the files. manifest: bucket, path, number of ids and bytes of each file, so the driver holds a row a file."""
    shared.ship(spark)
    files, start = [], 0
    for bucket, path, n_ids, n_bytes in sorted(manifest):
        files.append((len(files), path, start, n_bytes))
        start += n_ids
    listed = spark.createDataFrame(files, "file int, path string, start long, n_bytes long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = shared.schema_of(RESULT)
        for batch in batches:
            for row in batch.to_pylist():
                source, path = filesystem(row["path"])
                with source.open_input_file(path) as file:
                    rows: list[tuple] = []
                    for doc_id, at, ids in Reader(file, row["n_bytes"]).documents():
                        rows.append((doc_id, row["start"] + at, len(ids) // 4, zlib.crc32(ids)))
                        if len(rows) >= 8192:
                            yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)
                            rows = []
                    yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)

    return listed.repartitionById(max(1, len(files)), F.col("file")).mapInArrow(read, RESULT)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, to: str | None = None, **how) -> DataFrame:
    """Writes the files (to a folder of the shared one by default) and reads them back: RESULT for each document."""
    spark = docs.sparkSession
    manifest = write_files(docs, to or shared.fresh(spark, "ids"), tokenizer, end_id, **how).collect()
    return read_files(spark, [(r["bucket"], r["path"], r["n_ids"], r["n_bytes"]) for r in manifest])

"""Best-fit packing: bounded-space online best-fit.

A packer holds a fixed number of open bins. A bitset has a bit for each free space that an open bin has, so that the
tightest bin for a piece is the lowest set bit from the piece's length on. A piece that fits nowhere opens a bin; if all
places are taken, the fullest bin closes first.

Each task packs its own pieces, longest first, with as many bins open as it has pieces, so none closes before the short pieces
come that fill it, and the sequences that stay part empty are a few for each task.

Defined cases: a null or empty text is its end id alone; repeated rows are packed as often as they come; other columns
are ignored; an empty table gives no rows; a text longer than a sequence is cut, its first piece the shorter one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import shared
from gleanery.llm.tokenizing import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RESULT = f"{PIECES}, sequence_id long, offset long"
#: Pieces that a task packs: at 40 bytes each a small sort, and enough to leave few sequences part empty.
TASK_PIECES = 100_000
#: Bins that a packer holds open: all that a task's pieces can open, tasks being dealt by hash and so of about that size.
OPEN_BINS = 2 * TASK_PIECES


class BestFit:
    """Bounded-space online best-fit for pieces of 1 to size tokens; place(length) gives the bin's number and the offset in it."""

    def __init__(self, size: int, open_bins: int = OPEN_BINS):
        self.size, self.most = size, open_bins
        self.at: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by free space
        self.free = 0  # bitset of the free spaces that open bins have
        self.n_open = self.n_bins = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.n_open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.n_bins, self.size
            self.n_bins += 1
        if space > length:
            self.at[space - length].append(number)
            self.free |= 1 << (space - length)
            self.n_open += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        """An open bin with so much free space, no longer open."""
        bins = self.at[space]
        number = bins.pop()
        if not bins:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return number


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n tokens; the first piece takes what isn't a whole sequence."""
    first = n % size or size
    if n <= size:
        return [(0, n)]
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """PIECES for each document: its ids and the end id, cut where they are longer than a sequence."""
    shared.ship(docs.sparkSession)
    schema_ddl = PIECES

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, end = shared.schema_of(schema_ddl), end_id.to_bytes(4, "little")
        for batch in shared.slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer).encode(shared.texts_of(batch)), strict=True):
                ids += end
                view = memoryview(ids)
                rows += [(doc_id, k, s, n, zlib.crc32(view[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, size))]
            yield pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(schema)}, schema=schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(shared.lean(tokenised, "gleanery.llm.tokenizing"), PIECES)


def pack(items: DataFrame, size: int, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """items (PIECES) with sequence_id and offset."""
    n = max(1, -(-items.count() // task_pieces))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer = BestFit(size, open_bins)
        for batch in batches:
            places = [packer.place(x) for x in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([base + p for p, _ in places], pa.int64()), pa.array([o for _, o in places], pa.int64())], schema=shared.schema_of(RESULT))

    dealt = items.repartition(n, F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "start", "ids_crc32")
    return dealt.mapInArrow(shared.lean(packed), RESULT)


def best_fit_packing(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024, open_bins: int = OPEN_BINS) -> DataFrame:
    """RESULT for each piece. Pieces are written once, since both their count and the packing read them."""
    return pack(shared.written(pieces(docs, tokenizer, end_id, size), "pieces"), size, open_bins)

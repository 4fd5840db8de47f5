"""All pairs of the rows of a group, of any size, block against block: near ones, and what they connect.

Rows are dealt into blocks by their id, and each two blocks of a group meet in a Python worker, which holds these two alone and
compares a tile of their pairs at a time by numpy. A task's memory is bounded by the block, rows are moved once for each block of
their group (a large group has one for MOST_ROWS rows), and no list of pairs is made but of those that are near. There are as many
tasks as meetings of two full blocks, so the rows that a task sorts don't grow with the square of a group either.

What is connected needs no list of them either: each block gives a star for each of its components, then each two blocks give
stars of what connects these. Rows that are connected already aren't compared, so a group that is one component soon is one.

Defined cases: rows of one id are one node and no pair; a null group, id or value has no pair; vectors of different
lengths, with a zero norm, or with a missing or undefined number have no pair; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.durable import durable
from gleanery.operators.graph import connected_components, unite
from gleanery.operators.ranking import join_groups
from gleanery.shipping import ship

#: Rows of a block: so many at most; as few as the least while a group has under MANY_BLOCKS, so that many tasks share it.
MOST_ROWS, LEAST_ROWS, MANY_BLOCKS = 65_536, 4_096, 10
#: Rows that are compared at a time, with so many others.
TILE_ROWS, TILE_OTHERS = 128, 4_096
#: Pairs that a batch holds before it is given out.
PAIRS_AT_ONCE = 1 << 16
#: Cosine distances that far from the limit are settled by the product of matrices, the others one by one.
MARGIN = 1e-9
#: Norms for which that margin holds.
PLAIN_NORMS = 1e-100, 1e100


class Hashes:
    """64-bit hashes that differ in at most so many bits."""

    def __init__(self, column: pa.ChunkedArray, most: float):
        self.x, self.most = column.to_numpy().view(np.uint64), int(most)
        self.kind = np.zeros(len(self.x), dtype=np.int64)

    def near(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        apart = np.bitwise_count(self.x[rows][:, None] ^ self.x[others])
        at = np.flatnonzero(apart.reshape(-1) <= self.most)
        return rows[at // len(others)], others[at % len(others)], apart.reshape(-1)[at]


class Vectors:
    """Vectors of one length within a cosine distance, rounded to 12 digits, in double precision."""

    def __init__(self, column: pa.ChunkedArray, most: float):
        vectors = column.combine_chunks()
        lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.x, self.most = np.zeros((len(lengths), int(lengths.max(initial=0)))), most
        self.x[np.repeat(np.arange(len(lengths)), lengths), place] = values
        self.norm = np.sqrt(in_order(self.x, self.x))
        self.kind = np.where((self.norm > 0) & ~np.isnan(self.x).any(axis=1), lengths, -1)
        self.odd = (self.kind >= 0) & ~((self.norm > PLAIN_NORMS[0]) & (self.norm < PLAIN_NORMS[1]))
        self.unit = self.x / np.where((self.kind >= 0) & ~self.odd, self.norm, 1)[:, None]
        self.unit[self.odd] = 0

    def near(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        like = self.unit[rows] @ self.unit[others].T
        like[self.odd[rows]] = 1 - self.most
        like[:, self.odd[others]] = 1 - self.most
        at = np.flatnonzero(like.reshape(-1) >= 1 - self.most - MARGIN)
        like, i, j = like.reshape(-1)[at], rows[at // len(others)], others[at % len(others)]
        open_ = np.flatnonzero(like < 1 - self.most + MARGIN)
        good = np.ones(len(at), dtype=bool)
        good[open_] = self.within(i[open_], j[open_])
        return i[good], j[good], 1 - like[good]

    def within(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            size = self.norm[i] * self.norm[j]
            apart = np.where(size == 0, np.nan, 1 - in_order(self.x[i], self.x[j]) / size)
        good = apart <= self.most
        for k in np.flatnonzero(np.abs(apart - self.most) < 1e-11).tolist():
            good[k] = float(Decimal(repr(float(apart[k]))).quantize(Decimal("1e-12"), ROUND_HALF_UP)) <= self.most
        return good


def in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of products of each row, added up in order, as the JVM does."""
    out = np.zeros(len(x))
    with np.errstate(all="ignore"):
        for k in range(x.shape[1]):
            out = out + x[:, k] * y[:, k]
    return out


def _sides(kind: np.ndarray, side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows and others of a kind to be compared: of two blocks each with each, of one (no side) all with all."""
    for k in np.unique(kind[kind >= 0]):
        rows = np.flatnonzero(kind == k)
        yield (rows, rows) if side is None else (rows[~side[rows]], rows[side[rows]])


def near_pairs(values: Hashes | Vectors, side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each near pair of rows once, and how far they are apart."""
    for rows, others in _sides(values.kind, side):
        for start in range(0, len(rows), TILE_ROWS):
            some = rows[start : start + TILE_ROWS]
            for at in range(start if side is None else 0, len(others), TILE_OTHERS):
                i, j, apart = values.near(some, others[at : at + TILE_OTHERS])
                once = i < j if side is None else slice(None)
                yield i[once], j[once], apart[once]


def roots(values: Hashes | Vectors, side: np.ndarray | None, node: np.ndarray, n_nodes: int) -> np.ndarray:
    """For each of the nodes, of which the rows are, the least that near pairs connect it with. Rows of the node with most rows are
    compared with rows of other nodes alone, where what is connected is one node."""
    root = np.arange(n_nodes)
    for rows, others in _sides(values.kind, side):
        for start in range(0, len(rows), TILE_ROWS):
            some = rows[start : start + TILE_ROWS]
            behind = others[start:] if side is None else others
            most = np.bincount(root[node[rows]], minlength=n_nodes) + (np.bincount(root[node[others]], minlength=n_nodes) if side is not None else 0)
            most = int(most.argmax())
            inner = root[node[some]] == most
            for part, against in ((some[inner], behind[root[node[behind]] != most]), (some[~inner], behind)):
                for at in range(0, len(against) if len(part) else 0, TILE_OTHERS):
                    tile = against[at : at + TILE_OTHERS]
                    if len(np.unique(root[node[part]])) == 1:  # what a tile before has connected
                        tile = tile[root[node[tile]] != root[node[part[0]]]]
                    if len(tile):
                        i, j, _ = values.near(part, tile)
                        unite(root, node[i], node[j])
    return root


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole meetings: rows in order of group and the two blocks; holds one between batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        for c in ("part", "i", "j"):
            column = batch.column(c)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] |= bool(held) and held[-1].column(c)[-1].as_py() != column[0].as_py()
        starts = np.unique([0, *np.flatnonzero(new).tolist()]).tolist()
        for start, end in zip(starts, [*starts[1:], n], strict=True):
            if held and new[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _side(table: pa.Table) -> np.ndarray | None:
    i, j, own = (table.column(c).to_numpy() for c in ("i", "j", "own"))
    return None if i[0] == j[0] else own == j


def _pairs(kind: type, most: float) -> Callable:
    """part, u, v and distance of near rows."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            id_, part = table.column("id").to_numpy(), table.column("part").combine_chunks()
            held, n = [], 0

            def given(held=held, id_=id_, part=part) -> pa.RecordBatch:
                i, j, apart = (np.concatenate(x) for x in zip(*held, strict=True))
                u, v = np.minimum(id_[i], id_[j]), np.maximum(id_[i], id_[j])
                other = u != v
                group = part.take(pa.array(np.zeros(int(other.sum()), dtype=np.int64)))
                return pa.RecordBatch.from_arrays([group, *(pa.array(x[other]) for x in (u, v, apart.astype(np.float64)))], names=["part", "u", "v", "distance"])

            for found in near_pairs(kind(table.column("x"), most), _side(table)):
                if len(found[0]):
                    held.append(found)
                    n += len(found[0])
                    if n >= PAIRS_AT_ONCE:
                        yield given()
                        held.clear()
                        n = 0
            if held:
                yield given()

    return pairs


def _stars(kind: type, most: float) -> Callable:
    """u and the least v that near rows connect it with, of the rows' nodes."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            nodes, node = np.unique(table.column("node").to_numpy(), return_inverse=True)
            root = roots(kind(table.column("x"), most), _side(table), node, len(nodes))
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], names=["u", "v"])

    return stars


def _n_blocks(n: Column) -> Column:
    few = F.least(F.ceil(n / LEAST_ROWS), F.lit(MANY_BLOCKS))
    return F.greatest(few, F.ceil(n / MOST_ROWS)).cast("int")


def _in_groups(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """part, id and x of rows that may have a pair, with the number of blocks of their group and their own; how many rows there are, and
    how many at all meetings of their blocks."""
    rows = rows.where("part is not null and id is not null and x is not null")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    total, met = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * _n_blocks(F.col("n"))), F.lit(0))).first()
    joined = join_groups(rows, sizes.where("n > 1"), "part", "n", total).where("n is not null")
    return joined.withColumn("blocks", _n_blocks(F.col("n"))).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("n"), total, met


def _meeting(rows: DataFrame, others: Column, n_rows: int) -> DataFrame:
    """The rows at their meetings with the other blocks, in order. n_rows: how many that makes."""
    ship(rows.sparkSession)
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // (2 * MOST_ROWS)))
    dealt = rows.withColumn("other", F.explode(others)).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")
    return dealt.repartition(n, "part", "i", "j").sortWithinPartitions("part", "i", "j")


def pairs_near(rows: DataFrame, kind: type, most: float) -> DataFrame:
    """part, u < v and distance (not rounded) of the ids of a group that are near. rows: part, id (long) and x, a hash (long) or vector."""
    group = rows.schema["part"].dataType.simpleString()
    rows, _, n_met = _in_groups(rows)
    met = _meeting(rows, F.sequence(F.lit(0), F.col("blocks") - 1), n_met)
    return met.mapInArrow(_pairs(kind, most), f"part {group}, u long, v long, distance double")


def components_near(rows: DataFrame, kind: type, most: float, edges: DataFrame | None = None) -> DataFrame:
    """node and component, the least id that near pairs inside groups connect it with, of each id that has a pair. An id is of one
    group. rows: as in pairs_near. edges: u and v of further pairs."""
    rows, n_rows, n_met = _in_groups(rows)
    schema = "u long, v long"
    own = durable(_meeting(rows.withColumn("node", F.col("id")), F.array("own"), n_rows).mapInArrow(_stars(kind, most), schema))
    named = own.select(F.col("u").alias("node"), F.col("v").alias("component"))
    several = rows.where("blocks > 1")
    if edges is None and several.isEmpty():
        return named.unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    labels = own.select(F.col("u").alias("id"), F.col("v").alias("label"))
    labelled = several.join(labels, "id", "left").withColumn("node", F.coalesce("label", "id")).drop("label")
    apart = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("own"))
    links = _meeting(labelled, apart, n_met).mapInArrow(_stars(kind, most), schema)
    if edges is not None:
        at = lambda end: F.coalesce(f"label_{end}", end).alias(end)
        for end in ("u", "v"):
            edges = edges.join(labels.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")), end, "left")
        links = links.unionByName(edges.select(at("u"), at("v")))
    found = connected_components(durable(links.distinct()))
    every = named.withColumnRenamed("component", "label").unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("label"))).unionByName(found.select("node", F.col("node").alias("label"))).distinct()
    ends = found.select(F.col("node").alias("label"), "component")
    return every.join(ends, "label", "left").select("node", F.coalesce("component", "label").alias("component"))

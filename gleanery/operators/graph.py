"""Connected components of a graph of any size, by alternating large and small stars; of few edges, on the driver."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.durable import durable

#: Up to so many edges (counted, 16 bytes each) are connected on the driver: rounds of joins take seconds each for any few.
DRIVER_EDGES = 1 << 17


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each upper end has one edge and is no lower end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Connects nodes a with nodes b. root: for each node the least one that it is connected with, before and after."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _few(edges: pa.Table) -> pa.Table:
    """node and component of the nodes of the edges."""
    nodes, at = np.unique(np.concatenate([edges.column(c).to_numpy() for c in ("u", "v")]), return_inverse=True)
    root = np.arange(len(nodes))
    unite(root, *at.reshape(2, -1))
    return pa.table({"node": nodes, "component": nodes[root]})


def connected_components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = durable, driver_edges: int | None = None) -> DataFrame:
    """edges: u, v (long), undirected. Gives node and component, its least node, for each node of an edge; lone nodes have none.

    Each round links every node to the least one among its neighbours, until the edges are stars around the least node of
    each component: a number of rounds that grows with the logarithm of the longest path. keep ends a round's lineage.
    Up to driver_edges edges (DRIVER_EDGES unless given) are connected on the driver instead, with the same result.
    """
    stars = keep(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    n = stars.count()
    if 0 < n <= (DRIVER_EDGES if driver_edges is None else driver_edges):
        return stars.sparkSession.createDataFrame(_few(stars.toArrow()))
    while not _is_star_forest(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(lower, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        stars = keep(small.unionByName(lower.select("u", F.col("least").alias("v"))).distinct())
    own = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)

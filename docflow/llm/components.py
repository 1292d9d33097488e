"""Connected components of an edge list, each node with the smallest id that it reaches.

Up to LOCAL_EDGES edges (a checked bound) one task joins them with a union-find; beyond it, rounds of large-star and
small-star steps, which are groupings and joins, run until nothing changes. Nothing is collected to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LOCAL_EDGES = 1_000_000


def _union(rows: pa.Table) -> pa.Table:
    a, b = rows.column("a").to_numpy(), rows.column("b").to_numpy()
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    x, y = places[: len(a)], places[len(a) :]
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            return pa.table({"node": nodes, "root": nodes[root]})


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b. Each node's larger (or smaller) neighbours are tied to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    tied = both.join(least, both["a"] == least["u"])
    if large:
        out = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(node, root) of every node of edges (a, b)."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if edges.count() <= local_edges:
        return edges.groupBy(F.lit(0).alias("all")).applyInArrow(_union, "node long, root long")
    state = None
    while True:
        edges = stored(_star(stored(_star(edges, True), "large"), False), "small")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return ends.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

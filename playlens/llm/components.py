"""Connected components of a link table: contracted in each task, then by alternating stars across tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common
from playlens.llm.common import stored

BLOCK = 1 << 18  # links that a task contracts at a time


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("u", "w").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    moved = edges.join(least, "u").where("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return moved.union(least.select("u", F.col("w").alias("v"))).where("u <> v").distinct()


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of some links and the least one it reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (further := root[root] != root).any():
            root[further] = root[root[further]]
    return nodes, nodes[root]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``BLOCK`` links ``(u, v)`` at a time, one link from each node to the least it reaches by them, itself perhaps."""
    held, count = [], 0

    def block() -> pa.RecordBatch:
        ends = (np.concatenate([rows.column(i).to_numpy() for rows in held]) for i in range(2))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in least_reached(*ends)], ["u", "v"])

    for rows in batches:
        held.append(rows)
        count += rows.num_rows
        if count >= BLOCK:
            yield block()
            held, count = [], 0
    if count:
        yield block()


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for each node with a link; root is the component's least node.

    Links are undirected longs; NULL ends, loops and repeats are ignored. Every task first contracts
    the links it holds. If so few are left that one task holds them, it finishes them; if not, rounds follow. Each
    is a minimum per node (combined before the shuffle, so a hub costs one row per
    task) and an equality join that adaptive execution can split; rounds are written
    to the shared folder and grow with the logarithm of the longest chain. No links,
    no rows.
    """
    edges = links.where(F.col(left) != F.col(right)).select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = stored(edges.mapInArrow(_contracted, "u long, v long"), "cc")
    if edges.count() <= min(common.FEW, BLOCK):
        return edges.coalesce(1).mapInArrow(_contracted, "u long, v long").toDF("node", "root")
    edges = edges.where("u <> v")
    before = _signature(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "cc")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

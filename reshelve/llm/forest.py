"""Connected groups: inside a task with numpy, and over a whole table by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from reshelve.session import stored

# Star contraction needs a number of rounds that grows with the logarithm of a group's longest
# path; more rounds than this means the edges change while they are read.
MOST_ROUNDS = 60


def unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the trees of each pair in place; every parent ends as the least index of its tree."""
    while left.size:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent[:] = above


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one itself."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))))
        .alias("end")).select("end.*")
    sums = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return sums.where("below > 1 or below = 1 and above = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; the least node names it.

    Alternates large and small star steps, which link every node to the least one it knows,
    until all edges lead to roots. Least neighbours are aggregated before they are shuffled and
    joined back, so a node with very many neighbours is split as a skewed join. Each round is
    written to the shared checkpoint folder.
    """
    edges = stored(edges.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct())
    for _ in range(MOST_ROUNDS):
        edges = stored(_small_star(_large_star(edges)).distinct())
        if _is_settled(edges):
            least = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                least.select("node", F.col("node").alias("component")))
    raise RuntimeError("the groups did not settle")

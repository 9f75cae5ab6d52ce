"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside cells.

A vector lives in the cell of its nearest centroid. It also visits every earlier cell in which
a partner could live: y in cell c with cos(x, y) >= t needs (own - c) . x <= tan(acos t) times the
length of the part of own - c at right angles to x. That bound is exact, so every pair meets in
the home cell of one of the two, and meets once. On vectors without any structure the bound
lets most cells through and the work is that of comparing all blocks; on clustered ones few
cells are visited.

Results in odd cases:

* Vectors that are null, all zero, or hold null or non-finite components link with nothing and
  are their own component; so do vectors of different lengths with one another.
* Equal vectors are compared once and counted as often as they occur; rows may repeat.
* A row with a null id takes part. A component is named by its least id that is not null; a
  null id is never kept.
* An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from reshelve.llm.forest import components, unite
from reshelve.session import stored

COSINE = 0.95
# The centroids are fitted on the vectors with the least hashes: at most SAMPLE_ROWS of them
# and SAMPLE_VALUES numbers (32 MB). All vectors are assigned and compared.
SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 4_000_000
CELL_ROWS = 2048
MAX_CELLS = 4096
ROUNDS = 10
# Rows and columns of the blocks that one task compares, and rows multiplied at once.
BLOCK_ROWS = 2048
BLOCK_COLUMNS = 4096
STRIP = 256
# Keeps rounding from losing a visit; the products decide about links.
SLACK = 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest part first, so squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means of unit vectors; a centroid that loses all its vectors stays."""
    found = sample[:cells].copy()
    for _ in range(rounds):
        nearest = (sample @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1)
        found[length > 0] = sums[length > 0] / length[length > 0, None]
    return found


def _assign(centres: np.ndarray, cosine: float):
    tangent = math.tan(math.acos(cosine))
    gaps = np.maximum(2 - 2 * centres @ centres.T, 0)

    def cells(vectors: pd.Series) -> pd.Series:
        """The home cell, then the earlier cells visited."""
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = unit(np.stack(vectors.to_numpy()).astype(np.float64))
        near = x @ centres.T
        home = near.argmax(axis=1)
        margin = near[np.arange(len(x)), home][:, None] - near
        across = np.sqrt(np.maximum(gaps[home] - margin ** 2, 0))
        visits = margin <= tangent * across + SLACK
        visits &= np.arange(len(centres)) < home[:, None]
        return pd.Series([np.r_[h, np.flatnonzero(v)] for h, v in zip(home, visits)])

    return F.pandas_udf(cells, "array<int>")


def _compare(cosine: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the row side and the column side of one pair of blocks."""
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "root": []})
        x = unit(np.stack(left["vector"].to_numpy()).astype(np.float64))
        y = unit(np.stack(right["vector"].to_numpy()).astype(np.float64))
        nodes, place = np.unique(np.r_[left["node"], right["node"]], return_inverse=True)
        at_left, at_right = place[:len(x)], place[len(x):]
        parent = np.arange(len(nodes))
        links = np.zeros(len(nodes), np.int64)
        n_left, n_right = left["copies"].to_numpy(), right["copies"].to_numpy()
        guest = right["guest"].to_numpy()
        for start in range(0, len(x), STRIP):
            a, b = np.nonzero(x[start:start + STRIP] @ y.T >= cosine)
            a += start
            other = at_left[a] != at_right[b]
            a, b = a[other], b[other]
            np.add.at(links, at_left[a], n_right[b])
            np.add.at(links, at_right[b[guest[b]]], n_left[a[guest[b]]])
            unite(parent, at_left[a], at_right[b])
        told = (links > 0) | (parent != np.arange(len(nodes)))
        return pd.DataFrame({"node": nodes[told], "links": links[told],
                             "root": nodes[parent[told]]})

    return compare


def _linked(vectors: DataFrame, count: int, size: int, cosine: float) -> DataFrame:
    """(node, links, root) parts for the distinct vectors of one length."""
    sample = (vectors.orderBy(F.xxhash64("vector"), "node")
              .limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // size))).select("vector").toPandas())
    sample = unit(np.stack(sample["vector"].to_numpy()).astype(np.float64))
    cells = min(MAX_CELLS, len(sample), math.ceil(count / CELL_ROWS))
    found = _assign(centroids(sample, cells), cosine)(F.col("vector"))
    rows = vectors.select("node", "copies", "vector", F.posexplode(found).alias("visit", "cell"))
    rows = rows.withColumn("guest", F.col("visit") > 0)
    sizes = rows.groupBy("cell").agg(
        F.ceil(F.count_if(~F.col("guest")) / BLOCK_ROWS).cast("int").alias("high"),
        F.ceil(F.count(F.lit(1)) / BLOCK_COLUMNS).cast("int").alias("wide"))
    rows = rows.join(F.broadcast(sizes), "cell")  # MAX_CELLS rows at most
    own = F.xxhash64("node")
    i, j = F.pmod(own, "high").cast("int"), F.pmod(own, "wide").cast("int")

    def upto(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keep = ["cell", "node", "copies", "vector", "guest"]
    left = rows.where("not guest").select(*keep, i.alias("i"), upto("wide").alias("j"),
                                          F.lit(0).alias("side"))
    right = rows.select(*keep, j.alias("j"), upto("high").alias("i"), F.lit(1).alias("side"))
    return left.unionByName(right).groupBy("cell", "i", "j").applyInPandas(
        _compare(cosine), "node long, links long, root long")


def groups(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for a table of vec_id and embedding."""
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v)
                      & (F.abs(v) < float("inf")))
    sound = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    given = given.withColumn("sound", sound)
    distinct = given.where("sound").groupBy("vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()))
    sizes = distinct.groupBy(F.size("vector").alias("size")).count().orderBy("size").collect()
    parts = distinct.select("node", F.lit(0).cast("long").alias("links"),
                            F.col("node").alias("root")).limit(0)
    for size, count in sizes:
        parts = parts.union(_linked(distinct.where(F.size("vector") == size), count, size, cosine))
    parts = stored(parts)
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(parts, "node", "root")
    nodes = distinct.join(links, "node", "left").join(found, "node", "left").select(
        "vector", "copies", "least", "links",
        F.coalesce("component", "node").alias("component"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "component").select("vector", "component_id", (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = given.where("sound").join(nodes, "vector").select("vec_id", "n_links", "component_id")
    alone = given.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The links and the component of every vector."""
    return groups(spark.read.parquet(f"{folder}/embeddings.parquet"))

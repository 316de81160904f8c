"""Agglomerative clustering by Ward's criterion over clustering features.

Rows are summed up into leaves by one aggregation: size, sum and sum of
squares of each (they add up when leaves merge). Where a table holds at most
``max_leaves`` different vectors each is a leaf of its own, so that the tree
is the exact one; beyond that the leaves are the cells of a k-means fit. The
leaf table is the model: its size is bounded by ``max_leaves``, whatever the
number of rows, and it is merged on the driver.

Merges run in rounds of reciprocal nearest neighbours: Ward's criterion is
reducible, so all pairs that are each other's nearest may be merged at once
and give the tree of one-by-one merging. Heights are those of ``ward.D2``:
the square root of twice the growth of the within sum of squares; merges of
equal rows (height 0) lie inside a leaf and are not listed. Among equally
near neighbours the one with the smaller first id is taken.

Rows must have complete features (``frame.drop_incomplete``). An empty table
gives a tree without leaves and no rows; a cut at more clusters than leaves
gives one cluster a leaf.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

MAX_LEAVES = 1_000


def ward_merges(sizes: np.ndarray, centers: np.ndarray) -> list[tuple[int, int, float, int]]:
    """``(left, right, height, size)`` by height; node i < len(sizes) is a
    leaf, node len(sizes) + s the result of merge s."""
    m = len(sizes)
    size = sizes.astype(float)
    growth = np.full((m, m), np.inf)      # of the within sum of squares, if the two merge
    for i in range(m):
        d = centers - centers[i]
        growth[i] = np.einsum("ij,ij->i", d, d) * size * size[i] / (size + size[i])
    np.fill_diagonal(growth, np.inf)
    node, low, made = np.arange(m), np.zeros(m), []
    alive = np.ones(m, bool)
    while alive.sum() > 1:
        near = growth.argmin(axis=1)
        pairs = [(i, near[i]) for i in np.flatnonzero(alive) if near[near[i]] == i and i < near[i]]
        for i, j in pairs:
            d = growth[i, j]
            height = max(math.sqrt(2 * max(d, 0.0)), low[i], low[j])
            total = size[i] + size[j]
            with np.errstate(invalid="ignore"):
                row = ((size[i] + size) * growth[i] + (size[j] + size) * growth[j] - size * d) / (total + size)
            alive[j] = False
            row[~alive] = row[i] = np.inf
            growth[i], growth[:, i] = row, row
            growth[j], growth[:, j] = np.inf, np.inf
            made.append((int(node[i]), int(node[j]), float(height), int(total)))
            node[i], size[i], low[i] = m + len(made) - 1, total, height
    # a parent is never lower than its children and made after them
    order = sorted(range(len(made)), key=lambda s: made[s][2])
    place = {m + s: m + at for at, s in enumerate(order)}
    return [(place.get(a, a), place.get(b, b), h, n) for a, b, h, n in (made[s] for s in order)]


class WardTree:
    """``leaf_rows`` is ``(id, leaf)``; leaves are numbered by their least id."""

    def __init__(self, leaf_rows: DataFrame, sizes: np.ndarray, centers: np.ndarray, leaf_ss: float):
        self.leaf_rows, self.sizes, self.centers, self.leaf_ss = leaf_rows, sizes, centers, leaf_ss
        self.steps = ward_merges(sizes, centers)

    def merges(self) -> DataFrame:
        """``(step, left, right, height, size)``, sides as in R's ``hclust``:
        -i is leaf i, s the result of step s."""
        m = len(self.sizes)
        side = lambda x: -(x + 1) if x < m else x - m + 1
        rows = [(s + 1, side(a), side(b), h, n) for s, (a, b, h, n) in enumerate(self.steps)]
        return self.leaf_rows.sparkSession.createDataFrame(rows, "step int, left int, right int, height double, size long")

    def leaf_clusters(self, k: int) -> list[int]:
        """The cluster of each leaf at a cut into ``k``, numbered by least id."""
        if k < 1:
            raise ValueError("k must be at least 1")
        m = len(self.sizes)
        parent = list(range(m + len(self.steps)))
        for s, (a, b, _, _) in enumerate(self.steps[:max(0, m - k)]):
            parent[a] = parent[b] = m + s
        names, out = {}, []
        for i in range(m):
            while parent[i] != i:
                i = parent[i]
            out.append(names.setdefault(i, len(names) + 1))
        return out

    def cut(self, k: int = 5) -> DataFrame:
        """``(id, cluster)``: the leaf map (at most ``max_leaves`` rows) is broadcast."""
        leaves = self.leaf_rows.sparkSession.createDataFrame(
            list(enumerate(self.leaf_clusters(k))), "leaf int, cluster int")
        return self.leaf_rows.join(F.broadcast(leaves), "leaf").drop("leaf")


def ward_linkage(scaled: DataFrame, id_col: str, in_col: str = "scaled", max_leaves: int = MAX_LEAVES, seed: int = 567) -> WardTree:
    """The Ward tree of the rows of ``scaled`` (``id``, vector)."""
    spark = scaled.sparkSession
    rows = scaled.select(id_col, in_col, vector_to_array(in_col).alias("_x"))
    exact = rows.select("_x").distinct().limit(max_leaves + 1).count() <= max_leaves
    if exact:
        key = "_x"
    else:
        rows = KMeans(k=max_leaves, seed=seed, featuresCol=in_col, predictionCol="_cell").fit(scaled).transform(rows)
        key = "_cell"
    first = rows.select("_x").first()
    p = len(first["_x"]) if first else 0
    feats = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first"),
                                   *[F.avg(F.col("_x")[i]).alias(f"m{i}") for i in range(p)],
                                   *[F.var_pop(F.col("_x")[i]).alias(f"v{i}") for i in range(p)])
             .orderBy(F.col("first").asc_nulls_last(), key).limit(max_leaves).collect())   # one row a leaf
    sizes = np.array([r["n"] for r in feats], dtype=np.int64)
    centers = np.array([[r[f"m{i}"] for i in range(p)] for r in feats], dtype=float).reshape(len(feats), p)
    leaf_ss = float(sum(r["n"] * sum(r[f"v{i}"] for i in range(p)) for r in feats))
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("leaf", T.IntegerType())])
    names = spark.createDataFrame([(r[key], i) for i, r in enumerate(feats)], schema)
    return WardTree(rows.join(F.broadcast(names), key).select(id_col, "leaf"), sizes, centers, leaf_ss)

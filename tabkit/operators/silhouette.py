"""Silhouette of Rousseeuw (1987) with Euclidean distances.

The mean distance of a row to a cluster is taken over a sample of the
cluster: the ``sample`` rows of least hash of their id. A cluster of no more
rows is taken whole, so small tables are exact (``std_error`` 0). Beyond
that, the error of a mean of ``m`` of ``n`` distances is
``s / sqrt(m) * sqrt(1 - m / n)``; it is carried into the width of each row
to first order, and the mean over rows bounds the error of the mean width
(a sum's standard deviation is at most the sum of them), so the mean width
lies within three ``std_error`` but for a chance of well under one percent.

The samples (k x ``sample`` vectors, bounded) are broadcast; rows are scored
where they lie, in blocks of NumPy. Rows of one-row clusters have width 0,
as has every row if there is one cluster only. Equal rows have distance 0;
a row with both means 0 has width 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

SAMPLE = 256
# Doubles in one block of differences.
_BLOCK = 1 << 22


def cluster_sample(rows: DataFrame, id_col: str, cluster: str, sample: int) -> DataFrame:
    """``(cluster, n, id, vector)`` of the rows of least hash in each cluster.
    Hashes are uniform, so those under a threshold a little above
    ``sample / n`` hold the least ones but for a chance of 1e-9; only they
    are ranked."""
    sizes = rows.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"))
    share = F.lit(sample + 6 * sample ** 0.5 + 18) / F.col("_n")
    h = F.xxhash64(F.col(id_col).cast("string"), F.lit("silhouette"))
    near = (rows.join(F.broadcast(sizes), cluster).withColumn("_h", h)
            .where((F.col("_h").cast("double") / float(1 << 64) + 0.5) <= share))
    ranked = near.groupBy(cluster, "_n").agg(F.array_sort(F.collect_list(F.struct("_h", id_col, "_x"))).alias("_all"))
    return ranked.select(cluster, "_n", F.explode(F.slice("_all", 1, sample)).alias("_s")).select(cluster, "_n", f"_s.{id_col}", "_s._x")


def _widths(x, own, inside, groups):
    """(a, b, width, standard error) of rows ``x`` of clusters ``own``.
    groups: (cluster, size, vectors); inside[c] tells which rows are in c's sample."""
    n = len(x)
    means, errors = np.full((n, len(groups)), np.inf), np.zeros((n, len(groups)))
    for g, (cluster, size, points) in enumerate(groups):
        m = len(points)
        dist = np.empty((n, m))
        step = max(1, _BLOCK // max(1, points.size))
        for lo in range(0, n, step):
            d = x[lo:lo + step, None, :] - points[None]
            dist[lo:lo + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
        mine = own == cluster
        # a row's distance to itself does not count
        used = m - (mine & inside[g])
        others = size - mine
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(used > 0, dist.sum(1) / used, 0.0)
            var = np.maximum((dist ** 2).sum(1) - used * mean ** 2, 0.0) / np.maximum(used - 1, 1)
            rest = np.clip(1 - used / np.maximum(others, 1), 0.0, 1.0)
            errors[:, g] = np.sqrt(var / np.maximum(used, 1) * rest)
        means[:, g] = mean
    at = {c: g for g, (c, _, _) in enumerate(groups)}
    home = np.array([at[c] for c in own], dtype=int)
    line = np.arange(n)
    a, ea = means[line, home], errors[line, home]
    means[line, home] = np.inf
    other = means.argmin(1)
    b, eb = means[line, other], errors[line, other]
    alone = np.array([groups[g][1] == 1 for g in home]) | (len(groups) == 1)
    b = np.where(np.isinf(b), 0.0, b)
    low, high = np.minimum(a, b), np.maximum(a, b)
    zero = alone | (high == 0)
    safe = np.where(high == 0, 1.0, high)
    width = np.where(zero, 0.0, (b - a) / safe)
    e_low, e_high = np.where(a < b, ea, eb), np.where(a < b, eb, ea)
    error = np.where(zero, 0.0, np.hypot(e_low / safe, low * e_high / safe ** 2))
    return a, b, width, error


def silhouette_widths(rows: DataFrame, id_col: str, cluster: str, vec: str, sample: int = SAMPLE) -> DataFrame:
    """``(id, cluster, a, b, width, std_error)``, one row per row; ``rows``
    holds an id, a cluster without nulls and an array of doubles."""
    data = rows.select(id_col, cluster, F.col(vec).cast("array<double>").alias("_x"))
    groups: dict = {}
    for r in cluster_sample(data, id_col, cluster, sample).collect():      # k x sample vectors
        groups.setdefault(r[cluster], (r["_n"], [], []))
        groups[r[cluster]][1].append(r["_x"])
        groups[r[cluster]][2].append(r[id_col])
    packed = [(c, n, np.array(x, dtype=float), set(ids)) for c, (n, x, ids) in sorted(groups.items())]
    shared = rows.sparkSession.sparkContext.broadcast(packed)
    names = data.schema

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        known = shared.value
        for pdf in batches:
            if not len(pdf):
                continue
            ids, own = pdf.iloc[:, 0], pdf.iloc[:, 1].to_numpy()
            x = np.array(pdf.iloc[:, 2].tolist(), dtype=float)
            inside = [ids.isin(s).to_numpy() for _, _, _, s in known]
            a, b, w, e = _widths(x, own, inside, [g[:3] for g in known])
            yield pd.DataFrame({id_col: ids, cluster: pdf.iloc[:, 1], "a": a, "b": b, "width": w, "std_error": e})

    from pyspark.sql import types as T
    schema = T.StructType([names[id_col], names[cluster]] + [T.StructField(c, T.DoubleType()) for c in ("a", "b", "width", "std_error")])
    return data.mapInPandas(run, schema)


def silhouette_summary(widths: DataFrame, cluster: str) -> DataFrame:
    """``(cluster, n, avg_width, std_error)`` per cluster and, with a null
    cluster, over all rows."""
    return (widths.rollup(cluster).agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("width").alias("avg_width"), F.avg("std_error").alias("std_error")))

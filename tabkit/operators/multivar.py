"""Standardisation, principal components and clustering on MLlib.

Inputs are ``(id, features...)`` frames; features become one ML vector
(``array_to_vector`` for an array column, ``VectorAssembler`` for scalar
columns). Fitting runs as distributed MLlib jobs over a cached feature
frame; the fitted models (p x k matrices, k centres) are small. Every
per-row result (scores, assignments) is produced by ``transform`` and keeps
the row id -- labels are never attached by position.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tabkit.plans.scalars import with_one_row

# Numbers in a block of vectors.
BLOCK_VALUES = 1 << 17


def features(df: DataFrame, cols: Sequence[str] | str, id_col: str,
             out: str = "features") -> DataFrame:
    """``(id, features)``: a vector column from scalar columns or one array
    column."""
    if isinstance(cols, str):
        return df.select(id_col, array_to_vector(F.col(cols).cast("array<double>")).alias(out))
    va = VectorAssembler(inputCols=list(cols), outputCol=out)
    return va.transform(df.select(id_col, *[F.col(c).cast("double") for c in cols])).select(id_col, out)


def standardize(feat: DataFrame, in_col: str = "features", out_col: str = "scaled") -> DataFrame:
    """z-scores with the sample standard deviation (n - 1), as R's ``scale``."""
    model = StandardScaler(inputCol=in_col, outputCol=out_col, withMean=True, withStd=True).fit(feat)
    return model.transform(feat).drop(in_col)


def standardize_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column-wise z-scores as plain columns (one aggregate row, broadcast)."""
    st = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                *[F.stddev_samp(c).alias(f"_s{i}") for i, c in enumerate(cols)])
    j = with_one_row(df, st)
    return j.select(*[c for c in df.columns if c not in cols],
                    *[F.try_divide(F.col(c) - F.col(f"_m{i}"), F.col(f"_s{i}")).alias(c) for i, c in enumerate(cols)])


class PcaResult:
    """Fitted PCA on standardised data (correlation-matrix PCA)."""

    def __init__(self, spark, model, p: int, n: int, names: list[str]):
        self.spark, self.model, self.p, self.n, self.names = spark, model, p, n, names
        pc = model.pc.toArray()                       # p x k, small
        self.signs = []
        for j in range(pc.shape[1]):
            col = pc[:, j]
            big = max(range(len(col)), key=lambda i: abs(col[i]))
            self.signs.append(1.0 if col[big] >= 0 else -1.0)
        self.loadings = pc * self.signs
        self.eigenvalues = [float(v) * p for v in model.explainedVariance.toArray()]

    def eig(self) -> DataFrame:
        """(component, eigenvalue, pct, cum_pct); eigenvalues sum to p."""
        rows, cum = [], 0.0
        for i, ev in enumerate(self.eigenvalues):
            pct = 100.0 * ev / self.p
            cum += pct
            rows.append((i + 1, ev, pct, cum))
        return self.spark.createDataFrame(rows, "component int, eigenvalue double, pct double, cum_pct double")

    def contributions(self) -> DataFrame:
        """Variable contribution % per axis (100 * loading^2); each axis sums
        to 100. ``mean_line`` = 100 / p."""
        rows = [(self.names[i], j + 1, 100.0 * float(self.loadings[i, j]) ** 2)
                for i in range(self.loadings.shape[0]) for j in range(self.loadings.shape[1])]
        df = self.spark.createDataFrame(rows, "variable string, component int, contrib double")
        return df.withColumn("mean_line", F.lit(100.0 / self.p))

    def top_contributions(self, top: int = 15) -> DataFrame:
        w = Window.partitionBy("component").orderBy(F.desc("contrib"), F.asc("variable"))
        return (self.contributions().withColumn("rank", F.row_number().over(w))
                .where(F.col("rank") <= top))

    def coordinates(self, scaled: DataFrame, id_col: str, k: int = 3,
                    in_col: str = "scaled") -> DataFrame:
        """Row scores on the first ``k`` axes, scaled as FactoMineR (data
        standardised with n, not n - 1) and with the fixed sign rule."""
        f = math.sqrt(self.n / (self.n - 1))
        t = self.model.transform(scaled).select(id_col, vector_to_array("pcs").alias("_a"))
        return t.select(id_col, *[(F.col("_a")[j] * (f * self.signs[j])).alias(f"dim{j + 1}")
                                  for j in range(k)])


def pca(scaled: DataFrame, ncp: int, names: list[str], in_col: str = "scaled") -> PcaResult:
    """PCA with ``k = min(ncp, p)`` components on standardised features."""
    p = len(names)
    n = scaled.count()
    model = PCA(k=min(ncp, p), inputCol=in_col, outputCol="pcs").fit(scaled)
    return PcaResult(scaled.sparkSession, model, p, n, names)


def total_ss(scaled: DataFrame, in_col: str = "scaled") -> float:
    """Total sum of squares around the column means (one aggregate)."""
    arr = scaled.select(vector_to_array(in_col).alias("a"))
    p = len(arr.first()["a"])
    agg = arr.agg(*[F.var_samp(F.col("a")[i]).alias(f"v{i}") for i in range(p)],
                  F.count(F.lit(1)).alias("n")).first()
    return float(sum(agg[f"v{i}"] for i in range(p)) * (agg["n"] - 1))


class KMeansResult:
    """``iterations`` the fit took; ``converged``: fewer than it might have taken."""

    def __init__(self, model, cost: float, seed: int, iterations: int = 0, converged: bool = True):
        self.model, self.cost, self.seed = model, cost, seed
        self.iterations, self.converged = iterations, converged

    def assignments(self, scaled: DataFrame, id_col: str, in_col: str = "scaled") -> DataFrame:
        return self.model.transform(scaled).select(id_col, (F.col("prediction") + 1).alias("cluster"))

    def centers(self, spark, names: list[str]) -> DataFrame:
        rows = [(i + 1, *[float(v) for v in c]) for i, c in enumerate(self.model.clusterCenters())]
        return spark.createDataFrame(rows, ["cluster", *names])


def _fit_kmeans(scaled, k, seed, max_iter, in_col):
    # not the cached frame itself: the fit then keeps its vectors ready, instead of decoding every row once an iteration
    m = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=in_col, initMode="k-means||").fit(scaled.select(in_col))
    steps = m.summary.numIter
    return KMeansResult(m, m.summary.trainingCost, seed, steps, steps < max_iter)


def kmeans_best(scaled: DataFrame, k: int = 5, n_starts: int = 25, seed: int = 567,
                max_iter: int = 100, in_col: str = "scaled", parallel: int = 4) -> KMeansResult:
    """k-means restarted from ``n_starts`` seeds (k-means|| init); the fit
    with the lowest within-cluster SS is kept (ties: lowest seed). Lloyd
    iterations, so labels differ from Hartigan-Wong: compare by cost, not
    by label. Restarts are independent jobs submitted ``parallel`` at a
    time over the same cached features. The result tells its iterations and
    whether it converged before ``max_iter``."""
    seeds = [seed + s for s in range(n_starts)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, n_starts))) as ex:
        fits = list(ex.map(lambda sd: _fit_kmeans(scaled, k, sd, max_iter, in_col), seeds))
    return min(fits, key=lambda f: (f.cost, f.seed))


def cluster_summary(scaled: DataFrame, km: KMeansResult, in_col: str = "scaled") -> DataFrame:
    """sizes, within SS per cluster, total/between SS (one row per cluster)."""
    spark = scaled.sparkSession
    centers = km.model.clusterCenters()
    cdf = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centers)],
                                "prediction int, center array<double>")
    t = km.model.transform(scaled).select("prediction", vector_to_array(in_col).alias("x"))
    t = t.join(F.broadcast(cdf), "prediction")
    d2 = F.aggregate(F.zip_with("x", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                     lambda acc, v: acc + v)
    per = t.groupBy("prediction").agg(F.count(F.lit(1)).cast("bigint").alias("size"),
                                      F.sum(d2).alias("within_ss"))
    tss = total_ss(scaled, in_col)
    w = Window.partitionBy(F.lit(0))  # k rows only
    return per.select((F.col("prediction") + 1).alias("cluster"), "size", "within_ss",
                      F.lit(tss).alias("total_ss"),
                      (F.lit(tss) - F.sum("within_ss").over(w)).alias("between_ss"))


def elbow(scaled: DataFrame, k_max: int = 10, seed: int = 567, n_starts: int = 1,
          in_col: str = "scaled") -> DataFrame:
    """Within-cluster SS for k = 1..k_max (k = 1 is the total SS)."""
    with ThreadPoolExecutor(max_workers=4) as ex:
        rows = list(ex.map(lambda k: (k, total_ss(scaled, in_col) if k == 1 else kmeans_best(scaled, k, n_starts, seed, in_col=in_col).cost), range(1, k_max + 1)))
    return scaled.sparkSession.createDataFrame(rows, "k int, wss double")


def silhouette(scaled: DataFrame, k_max: int = 10, seed: int = 567, in_col: str = "scaled") -> DataFrame:
    """Mean silhouette per k (MLlib: squared Euclidean distance, linear
    time; differs from the Euclidean silhouette of Rousseeuw 1987)."""
    ev = ClusteringEvaluator(featuresCol=in_col, predictionCol="prediction",
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    rows = []
    for k in range(2, k_max + 1):
        m = kmeans_best(scaled, k, 1, seed, in_col=in_col).model
        rows.append((k, float(ev.evaluate(m.transform(scaled)))))
    return scaled.sparkSession.createDataFrame(rows, "k int, silhouette double")


def _blocks(frame: DataFrame, in_col: str):
    """An RDD of blocks of vectors, each the bytes of their doubles one after the other."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            rows = max(1, BLOCK_VALUES // max(1, x.shape[1]))
            for k in range(0, len(x), rows):
                yield pa.RecordBatch.from_arrays([pa.array([x[k:k + rows].tobytes()], pa.binary())], names=["x"])

    return frame.select(vector_to_array(in_col).alias("x")).mapInArrow(run, "x binary").rdd.map(lambda r: bytes(r.x))


def _summed(blocks, centers: list[np.ndarray], costs: bool) -> np.ndarray:
    """One pass over the rows for several sets of centers, below each other:
    a row per center with the sum of the rows nearest to it, then their number
    or, with ``costs``, their squared distances to it."""
    every = np.concatenate(centers)
    edges = np.concatenate(([0], np.cumsum([len(c) for c in centers])))
    p = every.shape[1]

    def sums(parts: Iterator) -> Iterator:
        norms, out = (every * every).sum(1), np.zeros((len(every), p + 1))
        for part in parts:
            x = np.frombuffer(part).reshape(-1, p)
            far = norms - 2 * (x @ every.T)
            mine = np.zeros((len(every), len(x)))
            for lo, hi in zip(edges[:-1], edges[1:]):
                near = lo + far[:, lo:hi].argmin(1)
                mine[near, np.arange(len(x))] = 1
                if costs:
                    out[:, p] += np.bincount(near, ((x - every[near]) ** 2).sum(1), len(every))
            out[:, :p] += mine @ x
            out[:, p] += 0 if costs else mine.sum(1)
        yield out

    found = blocks.mapPartitions(sums)
    # many tasks' sums are added up by tasks before they go to the driver
    return sum(found.collect()) if blocks.getNumPartitions() <= 64 else found.treeReduce(np.add)


def kmeans_costs(scaled: DataFrame, ks: Sequence[int], seed: int = 567, max_iter: int = 100, tol: float = 1e-4,
                 in_col: str = "scaled") -> list[float]:
    """The cost of ``kmeans_best`` with one start, for each k: MLlib's first
    centers, then its iterations (until no center of a k moves more than
    ``tol``, ``max_iter`` at most; the cost is that before the last move), made
    for all k in one pass over the rows."""
    if not len(ks):
        return []
    centers = []
    for k in ks:
        m = KMeans(k=k, seed=seed, maxIter=0, featuresCol=in_col, initMode="k-means||").fit(scaled.select(in_col))
        centers.append(np.array(m.clusterCenters()))
    blocks = _blocks(scaled, in_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        before, going = list(centers), list(range(len(centers)))
        for _ in range(max_iter):
            if not going:
                break
            sums = _summed(blocks, [centers[i] for i in going], False)
            still = []
            for i, own in zip(going, _per_set(sums, [centers[i] for i in going])):
                before[i], n = centers[i], own[:, -1:]
                centers[i] = np.where(n > 0, own[:, :-1] / np.maximum(n, 1), before[i])
                if (((centers[i] - before[i]) ** 2).sum(1) > tol * tol).any():
                    still.append(i)
            going = still
        return [float(own[:, -1].sum()) for own in _per_set(_summed(blocks, before, True), before)]
    finally:
        blocks.unpersist()


def _per_set(sums: np.ndarray, centers: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(sums, np.cumsum([len(c) for c in centers])[:-1])


def gap_statistic(scaled: DataFrame, k_max: int = 10, b: int = 5, seed: int = 567,
                  in_col: str = "scaled") -> DataFrame:
    """Tibshirani et al. (2001): Gap(k) = mean_b log W*_b(k) - log W(k) with
    reference sets drawn uniformly in each column's range (same row count,
    generated by Spark from the data's own rows); s = sd * sqrt(1 + 1/B).
    The k-means fits of one set share their passes over its rows, and no
    more than two sets are kept at a time."""
    arr = scaled.select(vector_to_array(in_col).alias("a"))
    p = len(arr.first()["a"])
    rng = arr.agg(*[F.min(F.col("a")[i]).alias(f"lo{i}") for i in range(p)],
                  *[F.max(F.col("a")[i]).alias(f"hi{i}") for i in range(p)])
    base = with_one_row(arr, rng)

    def logs(frame):
        return [math.log(w) for w in [total_ss(frame, in_col)][:k_max] + kmeans_costs(frame, range(2, k_max + 1), seed, in_col=in_col)]

    def of_set(bi):
        if bi is None:
            return logs(scaled)
        cols = [(F.col(f"lo{i}") + F.rand(seed + 1000 * bi + i) * (F.col(f"hi{i}") - F.col(f"lo{i}")))
                for i in range(p)]
        ref = base.select(array_to_vector(F.array(*cols)).alias(in_col)).cache()
        try:
            return logs(ref)
        finally:
            ref.unpersist()

    with ThreadPoolExecutor(max_workers=2) as ex:
        own, *refs = ex.map(of_set, [None, *range(b)])
    rows = []
    for k in range(1, k_max + 1):
        logw = own[k - 1]
        ref_logs = [r[k - 1] for r in refs]
        m = sum(ref_logs) / b
        sd = math.sqrt(sum((x - m) ** 2 for x in ref_logs) / (b - 1)) if b > 1 else 0.0
        rows.append((k, m - logw, sd * math.sqrt(1 + 1 / b), logw, m))
    return scaled.sparkSession.createDataFrame(rows, "k int, gap double, s double, log_w double, mean_log_w_ref double")


def bisecting(scaled: DataFrame, id_col: str, k: int = 5, seed: int = 567,
              in_col: str = "scaled") -> DataFrame:
    """Divisive hierarchical clustering cut at k (re-aim of ``hcut``):
    ``(id, cluster)``. MLlib seeds each split at centre +- noise scaled by the
    centre's norm, so exactly centred data would never split; the features
    are translated by +1 first (Euclidean clusters do not change)."""
    shifted = scaled.select(id_col, array_to_vector(
        F.transform(vector_to_array(in_col), lambda v: v + 1.0)).alias("_shifted"))
    model = BisectingKMeans(k=k, seed=seed, featuresCol="_shifted").fit(shifted)
    return model.transform(shifted).select(id_col, (F.col("prediction") + 1).alias("cluster"))


def within_ss(scaled: DataFrame, labels: DataFrame, id_col: str, in_col: str = "scaled") -> DataFrame:
    """Size and within-cluster SS per cluster, recomputed from assignments
    (centres = member means), plus the total and between SS."""
    arr = scaled.select(id_col, vector_to_array(in_col).alias("x")).join(labels, id_col)
    p = len(arr.first()["x"])
    per = arr.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("bigint").alias("size"),
        sum((F.var_pop(F.col("x")[i]) for i in range(p)), F.lit(0.0)).alias("_v"))
    tss = total_ss(scaled, in_col)
    w = Window.partitionBy(F.lit(0))  # k rows only
    out = per.select("cluster", "size", (F.col("_v") * F.col("size")).alias("within_ss"))
    return out.select("*", F.lit(tss).alias("total_ss"),
                      (F.lit(tss) - F.sum("within_ss").over(w)).alias("between_ss"))


def cluster_map(coords: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Per-cluster centre and covariance on two axes (ellipse data)."""
    j = coords.join(labels, id_col)
    return j.groupBy("cluster").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg("dim1").alias("mean1"), F.avg("dim2").alias("mean2"),
        F.var_samp("dim1").alias("var1"), F.var_samp("dim2").alias("var2"),
        F.covar_samp("dim1", "dim2").alias("cov12"))


# ---- distances (re-aimed: rows against a bounded set of reference points) ---

def _once(value, use):
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def mid_ranks(x):
    """The mid-ranks of an array's elements (ties share their mean rank)."""
    # the mean of the first and the last place in the sorted array
    return _once(F.array_sort(x), lambda s: _once(F.reverse(s), lambda r: F.transform(
        x, lambda v: (F.array_position(s, v) + F.size(s) + 1 - F.array_position(r, v)) / F.lit(2.0))))


def centred(x):
    """An array's elements less their mean."""
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x).cast("double")
    return _once(mean, lambda m: F.transform(x, lambda v: v - m))


def pair_signs(x):
    """sign(x_j - x_i) of all pairs i < j of an array's elements, in order."""
    places = F.sequence(F.lit(1), F.size(x))
    return F.flatten(F.transform(places, lambda i: F.transform(
        F.slice(x, i + 1, F.size(x)), lambda v: F.signum(v - F.element_at(x, i)))))


def _dot(x, y):
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


# what a metric compares: computed once per row, and once per reference point
_FORMS = {"spearman": lambda x: centred(mid_ranks(x)), "pearson": centred, "kendall": pair_signs,
          "binary": lambda x: F.transform(x, lambda v: F.when(v != 0, F.lit(1.0)).otherwise(0.0))}


def _dist_expr(x, y, metric: str, power: float = 3.0):
    diff = F.zip_with(x, y, lambda a, b: a - b)
    if metric == "euclidean":
        return F.sqrt(F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + v * v))
    if metric == "manhattan":
        return F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + F.abs(v))
    if metric == "maximum":
        return F.array_max(F.transform(diff, lambda v: F.abs(v)))
    if metric == "minkowski":
        return F.pow(F.aggregate(diff, F.lit(0.0), lambda acc, v: acc + F.pow(F.abs(v), power)), 1 / power)
    if metric == "canberra":
        terms = F.zip_with(x, y, lambda a, b: F.when((F.abs(a) + F.abs(b)) > 0,
                                                      F.abs(a - b) / (F.abs(a) + F.abs(b))).otherwise(0.0))
        return F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    if metric == "binary":      # of the elements set on a side, the share set on one side only
        either = F.aggregate(F.zip_with(x, y, lambda a, b: F.greatest(a, b)), F.lit(0.0), lambda acc, v: acc + v)
        return F.when(either == 0, 0.0).otherwise(F.try_divide(either - _dot(x, y), either))
    # of centred elements or ranks, or of pair signs (tau-b: pairs in the same order less those in opposite order)
    if metric in ("kendall", "pearson", "spearman"):
        return 1 - F.try_divide(_dot(x, y), F.sqrt(_dot(x, x) * _dot(y, y)))
    raise ValueError(f"unknown metric {metric}")


def distances_to_points(rows: DataFrame, points: DataFrame, id_col: str, point_id: str,
                        metric: str = "euclidean", vec: str = "x", max_points: int = 1_000) -> DataFrame:
    """Distance of every row to every reference point (cluster centres,
    medoids...). The point set is size-checked, then inlined into the
    expression as a literal array, so each row is expanded in place (no
    join, no shuffle). The all-pairs row x row matrix is deliberately not
    offered. Metrics: euclidean, manhattan, maximum, minkowski, canberra,
    binary (an element counts as set unless it is 0), and 1 less the
    correlation: pearson, spearman, kendall (tau-b, ties included; null where
    a side is constant). Ranks and pair orders are formed once per row and
    once per point."""
    form = _FORMS.get(metric)
    if form is not None:
        rows = rows.select(id_col, form(F.col(vec).cast("array<double>")).alias(vec))
        points = points.select(point_id, form(F.col(vec).cast("array<double>")).alias(vec))
    pts = points.select(point_id, vec).limit(max_points + 1).collect()
    if len(pts) > max_points:
        raise ValueError(f"more than {max_points} reference points")
    lit_pts = F.array(*[F.struct(F.lit(p[0]).alias("pid"),
                                 F.array(*[F.lit(float(v)) for v in p[1]]).alias("y")) for p in pts])
    per_point = F.transform(lit_pts, lambda p: F.struct(
        p["pid"].alias(point_id), _dist_expr(F.col(vec), p["y"], metric).alias("distance")))
    return rows.select(id_col, F.inline(per_point))

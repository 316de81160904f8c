"""Standardisation, PCA and clustering bound to ``embeddings`` (64 floats
per row, the width of the source's ``ncp = 64``) and ``lineitem``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession, functions as F

from tabkit.functions.normal import norm_ppf_sql
from tabkit.operators import describe as D
from tabkit.operators import frame, linkage, silhouette as S
from tabkit.operators import multivar as M
from tabkit.plans.bind_describe import rounded
from tabkit.plans.scalars import with_one_row
from tabkit.plans.tables import table

DIMS = 64
NAMES = [f"e{i:02d}" for i in range(DIMS)]
SEED = 567


def _scaled_embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return M.standardize(M.features(e, "embedding", "vec_id")).cache()


def q_zscore_lineitem(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rounded(M.standardize_columns(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), 6)


SQL_ZSCORE = """
SELECT l_orderkey, l_linenumber,
       round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS l_quantity,
       round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER (), 6) AS l_extendedprice,
       round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS l_discount,
       round((l_tax - avg(l_tax) OVER ()) / stddev_samp(l_tax) OVER (), 6) AS l_tax
FROM lineitem"""


def q_standardize_embeddings(spark: SparkSession, sf_dir: str):
    s = _scaled_embeddings(spark, sf_dir)
    return s.select("vec_id", vector_to_array("scaled").alias("z"))


def q_standardized_values(spark: SparkSession, sf_dir: str):
    """The z-scores of ``standardize_embeddings``, one row per value."""
    s = _scaled_embeddings(spark, sf_dir)
    return rounded(s.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("dim", "z")), 6)


SQL_STANDARDIZED_VALUES = """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT vec_id, CAST(dim AS INTEGER) AS dim,
       round((x - avg(x) OVER (PARTITION BY dim)) / stddev_samp(x) OVER (PARTITION BY dim), 6) AS z FROM v"""


def q_pca_eig(spark: SparkSession, sf_dir: str):
    return M.pca(_scaled_embeddings(spark, sf_dir), DIMS, NAMES).eig()


def q_pca_top_contrib(spark: SparkSession, sf_dir: str):
    res = M.pca(_scaled_embeddings(spark, sf_dir), DIMS, NAMES)
    return res.top_contributions(15).where(F.col("component") <= 4)


def q_pca_coords(spark: SparkSession, sf_dir: str):
    s = _scaled_embeddings(spark, sf_dir)
    return M.pca(s, DIMS, NAMES).coordinates(s, "vec_id", 3)


def q_pca_scores_saved(spark: SparkSession, sf_dir: str):
    """First three component scores written as parquet and read back."""
    from tabkit.plans.bind_sources import staging
    from tabkit.sinks.files import write_parquet
    s = _scaled_embeddings(spark, sf_dir)
    path = staging(spark, "pca-scores")
    write_parquet(M.pca(s, DIMS, NAMES).coordinates(s, "vec_id", 3), path)
    return spark.read.parquet(path)


def _best_kmeans(spark, sf_dir):
    s = _scaled_embeddings(spark, sf_dir)
    return s, M.kmeans_best(s, k=5, n_starts=25, seed=SEED)


def q_kmeans_assignments(spark: SparkSession, sf_dir: str):
    s, km = _best_kmeans(spark, sf_dir)
    return km.assignments(s, "vec_id")


def q_kmeans_summary(spark: SparkSession, sf_dir: str):
    s, km = _best_kmeans(spark, sf_dir)
    return M.cluster_summary(s, km)


def q_kmeans_centers(spark: SparkSession, sf_dir: str):
    s, km = _best_kmeans(spark, sf_dir)
    return km.centers(spark, NAMES)


def q_cluster_profile(spark: SparkSession, sf_dir: str):
    """Mean of the original columns per k-means cluster (label kept by id)."""
    s, km = _best_kmeans(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings")
    orig = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(NAMES[i]) for i in range(DIMS)])
    return D.profile_by(orig.join(km.assignments(s, "vec_id"), "vec_id").drop("vec_id"), "cluster")


def q_cluster_map(spark: SparkSession, sf_dir: str):
    s, km = _best_kmeans(spark, sf_dir)
    coords = M.pca(s, DIMS, NAMES).coordinates(s, "vec_id", 2)
    return M.cluster_map(coords, km.assignments(s, "vec_id"), "vec_id")


def q_elbow(spark: SparkSession, sf_dir: str):
    return M.elbow(_scaled_embeddings(spark, sf_dir), 10, SEED)


def q_silhouette(spark: SparkSession, sf_dir: str):
    return M.silhouette(_scaled_embeddings(spark, sf_dir), 10, SEED)


def q_gap_statistic(spark: SparkSession, sf_dir: str):
    return M.gap_statistic(_scaled_embeddings(spark, sf_dir), 10, 5, SEED)


def q_hierarchical(spark: SparkSession, sf_dir: str):
    s = _scaled_embeddings(spark, sf_dir)
    return M.within_ss(s, M.bisecting(s, "vec_id", 5, SEED), "vec_id")


def q_distances_to_centers(spark: SparkSession, sf_dir: str):
    s, km = _best_kmeans(spark, sf_dir)
    rows = s.select("vec_id", vector_to_array("scaled").alias("x"))
    pts = spark.createDataFrame([(i + 1, [float(v) for v in c]) for i, c in enumerate(km.model.clusterCenters())],
                                "cluster int, x array<double>")
    return M.distances_to_points(rows, pts, "vec_id", "cluster", "euclidean")


def _ward(spark, sf_dir):
    s = _scaled_embeddings(spark, sf_dir)
    return s, linkage.ward_linkage(s, "vec_id", seed=SEED)


def q_hierarchical_ward(spark: SparkSession, sf_dir: str):
    """The Ward tree cut into five: size and within SS of each cluster."""
    s, tree = _ward(spark, sf_dir)
    return M.within_ss(s, tree.cut(5), "vec_id")


def q_ward_merges(spark: SparkSession, sf_dir: str):
    return _ward(spark, sf_dir)[1].merges()


def q_ward_decomposition(spark: SparkSession, sf_dir: str):
    """All merges together undo the whole spread: rows under the root, and
    the growth of the within SS of all merges plus that inside the leaves."""
    tree = _ward(spark, sf_dir)[1]
    return tree.merges().agg(F.max("size").alias("n"), F.round(F.sum(F.col("height") * F.col("height") / 2) + tree.leaf_ss, 4).alias("total_ss"))


SQL_TOTAL_SS = """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
z AS (SELECT (x - avg(x) OVER (PARTITION BY dim)) / stddev_samp(x) OVER (PARTITION BY dim) AS z FROM v)
SELECT (SELECT count(*) FROM embeddings) AS n, round(sum(z * z), 4) AS total_ss FROM z"""


def q_kmeans_decomposition(spark: SparkSession, sf_dir: str):
    """Rows, rows at their nearest centre, and within plus between SS, the
    latter from the centres and sizes (the data's mean is 0)."""
    s = _scaled_embeddings(spark, sf_dir)
    km = M.kmeans_best(s, k=5, n_starts=5, seed=SEED)
    rows = s.select("vec_id", vector_to_array("scaled").alias("x"))
    centers = [(i + 1, [float(v) for v in c]) for i, c in enumerate(km.model.clusterCenters())]
    d = M.distances_to_points(rows, spark.createDataFrame(centers, "point int, x array<double>"), "vec_id", "point")
    near = d.groupBy("vec_id").agg(F.min_by("point", "distance").alias("nearest"))
    placed = near.join(km.assignments(s, "vec_id"), "vec_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("nearest") == F.col("cluster")).alias("n_nearest"))
    norms = spark.createDataFrame([(i, sum(v * v for v in c)) for i, c in centers], "cluster int, norm double")
    parts = M.cluster_summary(s, km).join(F.broadcast(norms), "cluster").agg(F.round(F.sum(F.col("within_ss") + F.col("size") * F.col("norm")), 2).alias("total_ss"))
    return with_one_row(placed, parts)


SQL_KMEANS_DECOMPOSITION = f"SELECT n, n AS n_nearest, round(total_ss, 2) AS total_ss FROM ({SQL_TOTAL_SS})"


def q_pca_identities(spark: SparkSession, sf_dir: str):
    """Sum and sum of squares of the eigenvalues: trace and squared norm of
    the correlation matrix."""
    eig = M.pca(_scaled_embeddings(spark, sf_dir), DIMS, NAMES).eig()
    return eig.agg(F.count(F.lit(1)).alias("components"), F.round(F.sum("eigenvalue"), 5).alias("trace"),
                   F.round(F.sum(F.col("eigenvalue") * F.col("eigenvalue")), 5).alias("squared_norm"))


SQL_PCA_IDENTITIES = """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
r AS (SELECT a.dim AS i, b.dim AS j, corr(a.x, b.x) AS r FROM v a JOIN v b USING (vec_id) GROUP BY 1, 2)
SELECT count(*) FILTER (i = j) AS components, round(sum(r) FILTER (i = j), 5) AS trace, round(sum(r * r), 5) AS squared_norm FROM r"""


def q_silhouette_labels(spark: SparkSession, sf_dir: str):
    """Euclidean silhouette of the given labels, per label and in all."""
    e = table(spark, sf_dir, "embeddings")
    w = S.silhouette_widths(e, "vec_id", "label", "embedding", sample=512)
    return rounded(S.silhouette_summary(w, "label").select("label", "n", "avg_width"), 6)


SQL_SILHOUETTE_LABELS = """
WITH d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS total, count(*) AS n
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
w AS (SELECT vec_id, label, max(total / n) FILTER (other = label) AS a, min(total / n) FILTER (other <> label) AS b FROM d GROUP BY 1, 2),
s AS (SELECT label, CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS width FROM w)
SELECT label, count(*) AS n, round(avg(width), 6) AS avg_width FROM s GROUP BY ROLLUP (label)"""


def _rank_distances(metric):
    def q(spark: SparkSession, sf_dir: str):
        """Distances of all rows to the first row of each label."""
        e = table(spark, sf_dir, "embeddings")
        # quantised, so that ranks have ties and some elements are not set
        rows = e.select("vec_id", F.transform("embedding", lambda v: F.round(v.cast("double"), 1)).alias("x"))
        first = e.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
        points = rows.join(F.broadcast(first), "vec_id").select("label", "x")
        return rounded(M.distances_to_points(rows, points, "vec_id", "label", metric), 6)
    return q


_SQL_RANK = """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS raw FROM embeddings),
x AS (SELECT vec_id, dim, round(raw, 1) AS x FROM v),
p AS (SELECT x.*, f.label FROM x JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY 1) f USING (vec_id)),
"""
SQL_SPEARMAN_DISTANCES = _SQL_RANK + """
rx AS (SELECT vec_id, dim, rank() OVER w + (count(*) OVER (PARTITION BY vec_id, x) - 1) / 2.0 AS r FROM x WINDOW w AS (PARTITION BY vec_id ORDER BY x)),
rp AS (SELECT label, dim, rank() OVER w + (count(*) OVER (PARTITION BY label, x) - 1) / 2.0 AS r FROM p WINDOW w AS (PARTITION BY label ORDER BY x))
SELECT rx.vec_id, rp.label, round(1 - corr(rx.r, rp.r), 6) AS distance FROM rx JOIN rp USING (dim) GROUP BY 1, 2"""
SQL_KENDALL_DISTANCES = _SQL_RANK + """
sx AS (SELECT a.vec_id, a.dim AS i, b.dim AS j, sign(b.x - a.x)::DOUBLE AS s FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.dim < b.dim),
sp AS (SELECT a.label, a.dim AS i, b.dim AS j, sign(b.x - a.x)::DOUBLE AS s FROM p a JOIN p b ON a.label = b.label AND a.dim < b.dim)
SELECT sx.vec_id, sp.label, round(1 - sum(sx.s * sp.s) / sqrt(sum(sx.s * sx.s) * sum(sp.s * sp.s)), 6) AS distance FROM sx JOIN sp USING (i, j) GROUP BY 1, 2"""
SQL_BINARY_DISTANCES = _SQL_RANK + """
b AS (SELECT x.vec_id, p.label, count(*) FILTER (x.x <> 0 OR p.x <> 0) AS n_either, count(*) FILTER (x.x <> 0 AND p.x <> 0) AS n_both FROM x JOIN p USING (dim) GROUP BY 1, 2)
SELECT vec_id, label, CASE WHEN n_either = 0 THEN 0.0 ELSE round((n_either - n_both) / n_either, 6) END::DOUBLE AS distance FROM b"""


def q_random_normal(spark: SparkSession, sf_dir: str):
    return frame.with_random_normal(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "rnorm", SEED)


def q_random_normal_keyed(spark: SparkSession, sf_dir: str):
    out = frame.with_random_normal(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "rnorm", SEED, ["l_orderkey", "l_linenumber"])
    return out.withColumn("rnorm", F.round("rnorm", 7))


SQL_RANDOM_NORMAL_KEYED = f"""
WITH u AS (SELECT l_orderkey, l_linenumber,
                  (CAST('0x' || substr(md5('{SEED}|=' || l_orderkey || '|=' || l_linenumber), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)!r}::DOUBLE AS u
           FROM lineitem)
SELECT l_orderkey, l_linenumber, round({norm_ppf_sql('u')}, 7) AS rnorm FROM u"""

QUERIES = {
    "zscore_lineitem": q_zscore_lineitem,
    "standardize_embeddings": q_standardize_embeddings,
    "standardized_values": q_standardized_values,
    "pca_eig": q_pca_eig,
    "pca_top_contrib": q_pca_top_contrib,
    "pca_coords": q_pca_coords,
    "pca_scores_saved": q_pca_scores_saved,
    "kmeans_assignments": q_kmeans_assignments,
    "kmeans_summary": q_kmeans_summary,
    "kmeans_centers": q_kmeans_centers,
    "cluster_profile": q_cluster_profile,
    "cluster_map": q_cluster_map,
    "elbow": q_elbow,
    "silhouette": q_silhouette,
    "gap_statistic": q_gap_statistic,
    "hierarchical": q_hierarchical,
    "distances_to_centers": q_distances_to_centers,
    "hierarchical_ward": q_hierarchical_ward,
    "ward_merges": q_ward_merges,
    "ward_decomposition": q_ward_decomposition,
    "kmeans_decomposition": q_kmeans_decomposition,
    "pca_identities": q_pca_identities,
    "silhouette_labels": q_silhouette_labels,
    "spearman_distances": _rank_distances("spearman"),
    "kendall_distances": _rank_distances("kendall"),
    "binary_distances": _rank_distances("binary"),
    "random_normal": q_random_normal,
    "random_normal_keyed": q_random_normal_keyed,
}
SQL = {"zscore_lineitem": SQL_ZSCORE, "random_normal_keyed": SQL_RANDOM_NORMAL_KEYED,
       "standardized_values": SQL_STANDARDIZED_VALUES, "ward_decomposition": SQL_TOTAL_SS, "kmeans_decomposition": SQL_KMEANS_DECOMPOSITION,
       "pca_identities": SQL_PCA_IDENTITIES, "silhouette_labels": SQL_SILHOUETTE_LABELS,
       "spearman_distances": SQL_SPEARMAN_DISTANCES, "kendall_distances": SQL_KENDALL_DISTANCES,
       "binary_distances": SQL_BINARY_DISTANCES}

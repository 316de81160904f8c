"""PCA / clustering invariants and NumPy brute-force checks on embeddings."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabkit.operators import multivar as M
from tests.conftest import SF001


@pytest.fixture(scope="module")
def data(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    feats = M.features(e, "embedding", "vec_id")
    scaled = M.standardize(feats).cache()
    X = np.array([r.embedding for r in e.orderBy("vec_id").collect()], dtype=float)
    return scaled, X


def test_standardize_matches_numpy(data):
    scaled, X = data
    Z = (X - X.mean(0)) / X.std(0, ddof=1)
    got = np.array([r.z for r in scaled.orderBy("vec_id").select(vector_to_array("scaled").alias("z")).collect()])
    assert np.allclose(got, Z, atol=1e-5)


def test_pca_eigenvalues_and_contributions(data):
    scaled, X = data
    names = [f"e{i:02d}" for i in range(X.shape[1])]
    res = M.pca(scaled, 64, names)
    eig = [r.eigenvalue for r in res.eig().orderBy("component").collect()]
    ref = np.sort(np.linalg.eigvalsh(np.corrcoef(X, rowvar=False)))[::-1]
    assert np.allclose(eig, ref, rtol=1e-4, atol=1e-4)
    assert sum(eig) == pytest.approx(64, rel=1e-6)
    assert res.eig().orderBy(F.desc("component")).first().cum_pct == pytest.approx(100.0, rel=1e-9)
    sums = {r.component: r.s for r in res.contributions().groupBy("component").agg(F.sum("contrib").alias("s")).collect()}
    assert all(v == pytest.approx(100.0, rel=1e-6) for v in sums.values())
    top = res.top_contributions(15).where("component = 1").collect()
    assert len(top) == 15 and top[0].contrib >= top[-1].contrib


def test_pca_scores_factominer_scale(data):
    scaled, X = data
    names = [f"e{i:02d}" for i in range(X.shape[1])]
    res = M.pca(scaled, 64, names)
    coords = res.coordinates(scaled, "vec_id", 3).orderBy("vec_id").collect()
    d1 = np.array([r.dim1 for r in coords])
    n = X.shape[0]
    # FactoMineR: scores of data standardised with n; their variance (1/n) is the eigenvalue
    assert np.mean((d1 - d1.mean()) ** 2) == pytest.approx(res.eigenvalues[0], rel=1e-4)


def test_kmeans_invariants(data):
    scaled, X = data
    km = M.kmeans_best(scaled, k=5, n_starts=3, seed=1)
    summ = M.cluster_summary(scaled, km).collect()
    n = X.shape[0]
    assert sum(r.size for r in summ) == n
    within = sum(r.within_ss for r in summ)
    assert within == pytest.approx(km.cost, rel=1e-6)
    assert within + summ[0].between_ss == pytest.approx(summ[0].total_ss, rel=1e-9)
    Z = (X - X.mean(0)) / X.std(0, ddof=1)
    assert summ[0].total_ss == pytest.approx(((Z - Z.mean(0)) ** 2).sum(), rel=1e-6)
    assert km.converged and 0 < km.iterations < 100
    assert not M.kmeans_best(scaled, k=5, n_starts=1, seed=1, max_iter=2).converged
    lab = {r.vec_id: r.cluster for r in km.assignments(scaled, "vec_id").collect()}
    assert set(lab.values()) <= {1, 2, 3, 4, 5} and len(lab) == n


def test_bisecting_splits_and_within_ss(data):
    scaled, X = data
    labels = M.bisecting(scaled, "vec_id", 4, 7)
    ws = M.within_ss(scaled, labels, "vec_id").collect()
    assert len(ws) == 4 and sum(r.size for r in ws) == X.shape[0]
    assert sum(r.within_ss for r in ws) < ws[0].total_ss


def test_elbow_k1_is_total(data):
    scaled, _ = data
    el = {r.k: r.wss for r in M.elbow(scaled, 3, 5).collect()}
    assert el[1] == pytest.approx(M.total_ss(scaled)) and el[3] < el[1]


def test_cluster_profile_has_every_dimension(spark):
    from tabkit.plans import bind_multivar as B
    out = B.q_cluster_profile(spark, SF001)
    assert [c for c in out.columns if c in B.NAMES] == B.NAMES
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").join(B.q_kmeans_assignments(spark, SF001), "vec_id").collect()
    for r in out.collect():
        mean = np.mean([x.embedding for x in rows if x.cluster == r.cluster], axis=0, dtype=float)
        assert np.allclose([r[n] for n in B.NAMES], mean, atol=1e-6)


def test_distance_metrics(spark):
    rows = spark.createDataFrame([(1, [0.0, 3.0, 4.0])], "id int, x array<double>")
    pts = spark.createDataFrame([(9, [1.0, 1.0, 1.0])], "pid int, x array<double>")
    x, y = np.array([0.0, 3, 4]), np.array([1.0, 1, 1])
    expect = {"euclidean": np.sqrt(((x - y) ** 2).sum()), "manhattan": np.abs(x - y).sum(),
              "maximum": np.abs(x - y).max(), "minkowski": (np.abs(x - y) ** 3).sum() ** (1 / 3),
              "canberra": (np.abs(x - y) / (np.abs(x) + np.abs(y))).sum()}
    for metric, val in expect.items():
        got = M.distances_to_points(rows, pts, "id", "pid", metric).first().distance
        assert got == pytest.approx(val), metric

"""Ward trees, Euclidean silhouettes and rank metrics against brute force."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tabkit.operators import linkage, multivar as M, silhouette as S


def _rows(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, x array<double>").repartition(4)
    return df.select("id", array_to_vector("x").alias("scaled"))


def _ward(x, k):
    """One-by-one merging by the definition: labels at k, and all heights."""
    groups, heights, cut = [[i] for i in range(len(x))], [], None
    while len(groups) > 1:
        if len(groups) == k:
            cut = [sorted(g) for g in groups]
        best = min((len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j)
                   for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        heights.append(np.sqrt(2 * best[0]))
        groups[best[1]] = groups[best[1]] + groups[best[2]]
        del groups[best[2]]
    return sorted(cut), heights


@pytest.mark.parametrize("seed", [1, 2])
def test_ward_equals_brute_force(spark, seed):
    x = np.random.default_rng(seed).normal(size=(60, 3))
    tree = linkage.ward_linkage(_rows(spark, x), "id")
    cut, heights = _ward(x, 5)
    got = {}
    for r in tree.cut(5).collect():
        got.setdefault(r.cluster, []).append(r.id)
    assert sorted(sorted(g) for g in got.values()) == cut
    assert [min(got[c]) for c in sorted(got)] == sorted(min(g) for g in cut)     # numbered by least id
    merges = tree.merges().orderBy("step").collect()
    assert np.allclose([m.height for m in merges], heights)
    assert merges[-1].size == 60
    for m in merges:                      # a side is a leaf or an earlier step, used once
        assert all(-60 <= v < 0 or 0 < v < m.step for v in (m.left, m.right))
    sides = [v for m in merges for v in (m.left, m.right)]
    assert len(set(sides)) == len(sides) == 118


def test_ward_ties_copies_and_edges(spark):
    x = np.array([[0.0, 0], [1, 0], [0, 1], [1, 1], [0, 0], [5, 5], [5, 5]])
    tree = linkage.ward_linkage(_rows(spark, x), "id")
    assert sorted(tree.sizes.tolist()) == [1, 1, 1, 2, 2]
    total = ((x - x.mean(0)) ** 2).sum()
    assert sum(h * h / 2 for _, _, h, _ in tree.steps) + tree.leaf_ss == pytest.approx(total)
    hs = [h for _, _, h, _ in tree.steps]
    assert hs == sorted(hs)
    two = {r.id: r.cluster for r in tree.cut(2).collect()}
    assert two == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2}
    assert {r.cluster for r in tree.cut(99).collect()} == {1, 2, 3, 4, 5}
    with pytest.raises(ValueError):
        tree.cut(0)
    empty = linkage.ward_linkage(_rows(spark, np.zeros((0, 2))), "id")
    assert empty.cut(3).count() == 0 and empty.merges().count() == 0
    one = linkage.ward_linkage(_rows(spark, np.array([[1.0, 2.0]] * 3)), "id")
    assert [r.cluster for r in one.cut(3).collect()] == [1, 1, 1] and one.merges().count() == 0


def test_ward_beyond_the_leaf_bound(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, size=(80, 2)) for c in ((0, 0), (8, 0), (0, 8))])
    tree = linkage.ward_linkage(_rows(spark, x), "id", max_leaves=25, seed=1)
    assert len(tree.sizes) <= 25 and tree.sizes.sum() == 240
    assert sum(h * h / 2 for _, _, h, _ in tree.steps) + tree.leaf_ss == pytest.approx(((x - x.mean(0)) ** 2).sum())
    got = {r.id: r.cluster for r in tree.cut(3).collect()}
    assert [got[i] for i in range(240)] == [1] * 80 + [2] * 80 + [3] * 80


def _silhouette(x, own):
    out = []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        mine = [j for j in range(len(x)) if own[j] == own[i] and j != i]
        others = [d[own == c].mean() for c in set(own.tolist()) if c != own[i]]
        if not mine or not others:
            out.append(0.0)
            continue
        a, b = d[mine].mean(), min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


def _widths(spark, x, own, **kw):
    df = spark.createDataFrame([(i, int(c), [float(v) for v in r]) for i, (c, r) in enumerate(zip(own, x))], "id long, c int, x array<double>").repartition(3)
    return S.silhouette_widths(df, "id", "c", "x", **kw)


def test_silhouette_is_exact_on_small_tables(spark):
    rng = np.random.default_rng(4)
    own = np.array([0] * 40 + [1] * 30 + [2])
    x = rng.normal(size=(71, 4)) + own[:, None]
    got = {r.id: r for r in _widths(spark, x, own).collect()}
    assert np.allclose([got[i].width for i in range(71)], _silhouette(x, own))
    assert all(r.std_error == 0 for r in got.values())
    total = S.silhouette_summary(_widths(spark, x, own), "c").where("c is null").first()
    assert total.n == 71 and total.avg_width == pytest.approx(_silhouette(x, own).mean())


def test_silhouette_of_samples_is_within_its_bound(spark):
    rng = np.random.default_rng(5)
    own = np.repeat([0, 1, 2], [900, 500, 20])
    x = rng.normal(size=(1420, 3)) + 1.5 * own[:, None]
    total = S.silhouette_summary(_widths(spark, x, own, sample=64), "c").where("c is null").first()
    assert 0 < total.std_error < 0.2
    assert abs(total.avg_width - _silhouette(x, own).mean()) <= 3 * total.std_error
    sizes = {r["c"]: r["count"] for r in S.cluster_sample(
        spark.createDataFrame([(i, int(c), [0.0]) for i, c in enumerate(own)], "id long, c int, _x array<double>"), "id", "c", 64).groupBy("c").count().collect()}
    assert sizes == {0: 64, 1: 64, 2: 20}


def test_silhouette_edges(spark):
    assert _widths(spark, np.zeros((0, 2)), np.zeros(0)).count() == 0
    one = _widths(spark, np.arange(8.0).reshape(4, 2), np.zeros(4)).collect()
    assert [r.width for r in one] == [0.0] * 4
    same = _widths(spark, np.zeros((4, 2)), np.array([0, 0, 1, 1])).collect()
    assert [r.width for r in same] == [0.0] * 4


def test_rank_metrics(spark):
    rng = np.random.default_rng(6)
    xs, ys = rng.integers(0, 4, size=(12, 7)).astype(float), rng.integers(0, 4, size=(3, 7)).astype(float)
    xs[0] = 2.0                                                     # constant: no correlation
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(xs)], "id int, x array<double>")
    pts = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(ys)], "pid int, x array<double>")

    def ranks(v):
        return np.array([(v < t).sum() + ((v == t).sum() + 1) / 2 for t in v])

    def kendall(v, w):
        s = [(np.sign(v[j] - v[i]), np.sign(w[j] - w[i])) for i in range(7) for j in range(i + 1, 7)]
        s = np.array(s)
        return 1 - (s[:, 0] * s[:, 1]).sum() / np.sqrt((s[:, 0] ** 2).sum() * (s[:, 1] ** 2).sum())

    def binary(v, w):
        a, b = v != 0, w != 0
        return (a ^ b).sum() / (a | b).sum() if (a | b).any() else 0.0

    expect = {"spearman": lambda v, w: 1 - np.corrcoef(ranks(v), ranks(w))[0, 1], "kendall": kendall, "binary": binary}
    for metric, f in expect.items():
        for r in M.distances_to_points(rows, pts, "id", "pid", metric).collect():
            if r.id == 0 and metric != "binary":
                assert r.distance is None
            else:
                assert r.distance == pytest.approx(f(xs[r.id], ys[r.pid])), (metric, r)

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tabkit.operators import multivar as M


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 3)) + np.repeat([[0, 0, 0], [4, 0, 1], [0, 5, 2]], 50, axis=0)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(150, [1.0, 1.0, 1.0])] * 2
    return spark.createDataFrame(rows, "id int, x array<double>").select("id", array_to_vector("x").alias("scaled"))


@pytest.mark.parametrize("parts, max_iter", [(3, 100), (70, 3)])
def test_kmeans_of_all_k_share_their_passes(points, monkeypatch, parts, max_iter):
    """Costs are those of MLlib's fits, k by k; the rows are passed over once an iteration, whatever number of k there are."""
    scaled = points.repartition(parts, "id").sortWithinPartitions("id").cache()
    want = [M.kmeans_best(scaled, k, 1, 7, max_iter) for k in (2, 3, 5)]
    passes, summed = [], M._summed
    monkeypatch.setattr(M, "_summed", lambda *a: passes.append(len(a[1])) or summed(*a))
    monkeypatch.setattr(M, "BLOCK_VALUES", 12)
    assert M.kmeans_costs(scaled, (2, 3, 5), 7, max_iter) == pytest.approx([w.cost for w in want], rel=1e-9)
    assert len(passes) == max(w.iterations for w in want) + 1 and passes[0] == passes[-1] == 3
    scaled.unpersist()


def test_gap_statistic_fits_the_sets_it_draws(points, monkeypatch):
    """Every reference set and the rows themselves are fitted for each k, in passes they share; sets go when they are done."""
    scaled = points.coalesce(2).cache()
    monkeypatch.setattr(M, "kmeans_best", None)
    calls, costs = [], M.kmeans_costs
    monkeypatch.setattr(M, "kmeans_costs", lambda f, ks, *a, **b: calls.append((f.count(), list(ks))) or costs(f, ks, *a, **b))
    before = points.sparkSession.sparkContext._jsc.getPersistentRDDs().size()
    rows = M.gap_statistic(scaled, 4, 2, 9).orderBy("k").collect()
    assert calls == [(152, [2, 3, 4])] * 3 and [r.k for r in rows] == [1, 2, 3, 4]
    assert rows[0].log_w == pytest.approx(np.log(M.total_ss(scaled))) and max(rows, key=lambda r: r.gap).k == 3
    assert points.sparkSession.sparkContext._jsc.getPersistentRDDs().size() <= before + 1
    assert [r.gap for r in M.gap_statistic(scaled, 1, 2, 9).collect()] == [rows[0].gap]
    scaled.unpersist()

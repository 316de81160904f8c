"""Spearman's exact p, keyed normal draws, NaN as missing."""

import itertools
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions import tails
from tabkit.operators import describe, frame, inference


def _sums(n):
    return [sum((i - v) ** 2 for i, v in enumerate(p)) for p in itertools.permutations(range(n))]


def _two_sided(sums, n, s):
    tail = sum(x >= s for x in sums) if s > (n ** 3 - n) / 6 else sum(x <= s for x in sums)
    return min(1.0, 2 * tail / len(sums))


@pytest.mark.parametrize("n", range(2, 9))
def test_rank_statistic_equals_enumeration(spark, n):
    sums = _sums(n)
    rows = [(float(s), float(n)) for s in range(0, (n ** 3 - n) // 3 + 1, 2)]
    got = spark.createDataFrame(rows, "s double, n double").select("s", tails.spearman_two_sided(F.col("s"), F.col("n")).alias("p")).collect()
    assert all(abs(r.p - _two_sided(sums, n, r.s)) < 1e-12 for r in got)


def test_rank_series_is_close_to_the_distribution(spark):
    """The series of 12 ranks against their counts."""
    n = 12
    counts = tails.rank_distance_counts(n)
    total, centre = sum(counts), (n ** 3 - n) / 6
    below = np.cumsum(counts)
    want = {2.0 * i: min(1, 2 * (below[i] if 2 * i <= centre else total - below[i] + c) / total) for i, c in enumerate(counts)}
    got = spark.createDataFrame([(s, float(n)) for s in want], "s double, n double").select("s", tails.spearman_two_sided(F.col("s"), F.col("n")).alias("p")).collect()
    assert max(abs(r.p - want[r.s]) for r in got) < 2e-3


def test_spearman_chooses_the_distribution(spark):
    def p(a, b):
        return inference.spearman_test(spark.createDataFrame(list(zip(a, b)), "a double, b double"), "a", "b", exact=True).first()

    x = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    y = [2.0, 1.0, 4.0, 3.0, 6.0, 5.0]
    assert abs(p(x, y).p_value - _two_sided(_sums(6), 6, 6)) < 1e-12
    tied = p(x, [2.0, 2.0, 4.0, 3.0, 6.0, 5.0])
    assert "ties" not in tied and abs(tied.p_value - _two_sided(_sums(6), 6, 6)) > 1e-3
    assert p([1.0], [1.0]).p_value is None


def test_keyed_normal_is_the_same_under_any_partitioning(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("g"))
    one = {r.k: r.rnorm for r in frame.with_random_normal(df.coalesce(1), "rnorm", 3, ["k"]).collect()}
    other = {r.k: r.rnorm for r in frame.with_random_normal(df.repartition(13, "g"), "rnorm", 3, ["k"]).collect()}
    assert one == other and abs(np.mean(list(one.values()))) < 0.03 and abs(np.std(list(one.values())) - 1) < 0.03
    reseeded = frame.with_random_normal(df, "rnorm", 4, ["k"]).collect()
    assert abs(np.corrcoef([one[r.k] for r in reseeded], [r.rnorm for r in reseeded])[0, 1]) < 0.03
    u = df.limit(50).select(frame.uniform_at(["k"], 3).alias("u"), "k").collect()
    assert all(abs(one[r.k] - statistics.NormalDist().inv_cdf(r.u)) < 1e-9 for r in u)
    nulls = spark.createDataFrame([(None,), ("-",), ("",)], "k string").select(frame.uniform_at(["k"], 1).alias("u")).collect()
    assert len({r.u for r in nulls}) == 3


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a", 1.5), (float("nan"), None, None), (None, "b", float("nan"))], "x double, s string, `f.g` float")
    assert describe.missing_total(df).first().missing_cells == 5
    assert {r.column: r.missing for r in describe.missing_share(df).collect()} == {"x": 2, "s": 1, "f.g": 2}
    assert {tuple(r) for r in describe.missing_patterns(df.drop("f.g")).collect()} == {(False, False, 1), (True, True, 1), (True, False, 1)}
    assert describe.missing_total(df.limit(0)).first().missing_cells == 0

"""Large degrees of freedom, zero divisors and hot keys."""

import math

import pytest
from pyspark.sql import functions as F

from tabkit.functions import dist
from tabkit.functions.columns import py_mod
from tabkit.operators import charts as V, describe as D, inference as H, multivar as M
from tabkit.plans.sizing import has_at_most
from tabkit.plans.skew import hot_hashes, salted_join


def normal_sf(z):
    return 0.5 * math.erfc(z / math.sqrt(2))


@pytest.mark.parametrize("df", [1e9, 1e12, 1e14, 1e15])
@pytest.mark.parametrize("t", [0.001, 0.5, 2.0, 4.0])
def test_t_tail_at_large_df(t, df):
    # first term of the expansion in 1 / df
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    want = 2 * (normal_sf(t) + density * t * (t * t + 1) / (4 * df))
    assert dist.t_sf2(t, df) == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("t", [0.001, 2.0, 5.0])
def test_t_tail_meets_its_limit_where_the_method_changes(t):
    below, above = dist.t_sf2(t, 2 * dist._LARGE * 0.999), dist.t_sf2(t, 2 * dist._LARGE * 1.001)
    assert below == pytest.approx(above, rel=1e-6)


def test_f_and_chi2_tails_at_large_df():
    for k in (1, 4, 50):
        for df in (1e12, 1e15):
            assert dist.f_sf(1.3, k, df) == pytest.approx(dist.chi2_sf(1.3 * k, k), rel=1e-6)
    assert dist.f_sf(3.0, 2, 10) == pytest.approx(1.6 ** -5, rel=1e-12)
    assert dist.f_sf(3.0, 2, 1e15) == pytest.approx(math.exp(-3.0), rel=1e-6)
    assert dist.f_sf(1 + 4e-6, 1e12, 1e12) == pytest.approx(normal_sf(2), rel=1e-4)
    assert dist.chi2_sf(1e12 + 2 * math.sqrt(2e12), 1e12) == pytest.approx(normal_sf(2), rel=1e-4)


def test_perfect_and_short_correlations(spark):
    df = spark.createDataFrame([("up", i, 2.0 * i) for i in range(5)] + [("down", i, -3.0 * i) for i in range(5)]
                               + [("flat", i, 1.0) for i in range(5)] + [("two", i, 1.0 * i) for i in range(2)]
                               + [("three", i, float(i * i)) for i in range(3)], "g string, a long, b double")
    got = {r["g"]: r for r in H.pearson_test(df, "a", "b", ["g"]).collect()}
    for g in ("up", "down"):
        assert got[g]["p_value"] == pytest.approx(0.0, abs=1e-12)
    assert got["two"]["statistic"] is None and got["three"]["conf_low"] is None
    one = H.spearman_test(df.where("g = 'up'"), "a", "b").first()
    assert one["p_value"] == pytest.approx(0.0, abs=1e-12)


def test_constant_data_does_not_stop_a_query(spark):
    df = spark.createDataFrame([("c", 1.0)] * 6 + [("v", float(x)) for x in (-2, -1, 0, 1, 2, 0)]
                               + [("n", None)] * 2, "g string, y double")
    d = {r["g"]: r for r in D.describe_column(df, "y", ["g"]).collect()}
    assert d["v"]["cv_pct"] is None and d["n"]["mean"] is None and d["c"]["mean"] == 1.0
    p = {r["g"]: r["p_value"] for r in H.lilliefors_test(df, "y", ["g"]).collect()}
    assert p["c"] is None or math.isnan(p["c"])
    assert p["v"] > 0.05
    const = df.where("g = 'c'")
    assert [(r["bin"], r["n"]) for r in V.histogram(const, "y", 4).collect()] == [(1, 6)]
    assert M.standardize_columns(const, ["y"]).where("y is not null").count() == 0
    both = const.union(const.withColumn("g", F.lit("d")))
    for test in (H.anova_test, H.levene_test, H.fligner_test):
        assert test(both, "y", "g").count() == 1
    assert H.welch_test(both, "y", "g", ["c", "d"]).first()["statistic"] is None


def test_modulo_by_zero_is_null(spark):
    df = spark.createDataFrame([(7, 0), (7, -3), (-7, 3)], "a int, b int")
    assert [r[0] for r in df.select(py_mod("a", "b")).collect()] == [None, -2, 2]


def test_many_hot_keys_and_equal_rows(spark):
    big = spark.createDataFrame([(k, "same") for k in range(20) for _ in range(10 + k)], "k int, v string") \
        .repartition(6)
    small = spark.createDataFrame([(k, str(k)) for k in range(20)], "k int, w string")
    got = salted_join(big, small, "k", "left", hot_rows=2, salt_buckets=4, max_hot_keys=5)
    assert got.count() == big.count() and got.where("w is null or cast(k as string) <> w").count() == 0


def test_size_check_counts_bytes(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "t string")
    assert has_at_most(df, 10) and not has_at_most(df, 9) and not has_at_most(df, 10, 5000)


def test_hot_keys_of_other_types(spark):
    """Both sides agree on what is hot when their key types differ, and for zeros and NaN."""
    big = spark.createDataFrame([(k, i) for k in (1, 2, None) for i in range(30)], "k int, v int").repartition(4)
    small = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (2 ** 40, "far")], "k long, w string")
    got = salted_join(big, small, "k", "inner", hot_rows=5, salt_buckets=4)
    assert sorted((str(r.k), r.w) for r in got.select("k", "w").distinct().collect()) == [("1", "a"), ("2", "b"), ("None", "n")] and got.count() == 90
    nan = float("nan")
    big = spark.createDataFrame([(x,) for x in (0.0, -0.0, nan) for _ in range(20)], "k double").repartition(3)
    assert salted_join(big, spark.createDataFrame([(-0.0, 1), (nan, 2)], "k double, w int"), "k", "left", hot_rows=5).where("w is null").isEmpty()


def test_heavy_hitters_are_found(spark):
    big = spark.range(200_000).selectExpr("if(id % 10 = 0, 7, id) AS k").repartition(5)
    assert hot_hashes(big, "k", 10_000) == [big.where("k = 7").selectExpr("xxhash64(k)").first()[0]]
    assert hot_hashes(big.limit(0), "k", 1) == []

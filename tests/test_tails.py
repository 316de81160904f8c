"""Tail probabilities as column expressions against the scalar forms."""

import math

import pytest
from pyspark.sql import functions as F

from tabkit.functions import dist, tails

T_CASES = [(t, v) for v in (0.5, 1.0, 2.0, 7.3, 30.0, 998.0, 60_000.0, 1.5e8, 3e9, 1e15) for t in (0.0, 1e-9, 0.3, 1.96, 8.5, 40.0, -2.5, float("inf"))]
CHI_CASES = [(x, v) for v in (1.0, 2.0, 4.0, 33.0, 5_000.0, 1e7, 4e8, 1e12) for x in (0.0, 0.01, 1.0, v * 0.9, v, v + 3 * math.sqrt(2 * v), 3 * v + 40)]
F_CASES = [(f, a, b) for a in (1.0, 2.0, 4.0, 50.0, 1e6, 1e9) for b in (1.0, 9.0, 595.0, 59_997.0, 1e9) for f in (0.0, 0.4, 1.0, 1.01, 3.3, 20.0, float("inf"))]


def near(got, want):
    return got == pytest.approx(want, rel=2e-8, abs=1e-13)


def test_t(spark):
    df = spark.createDataFrame(T_CASES, "t double, v double")
    for r in df.select("t", "v", tails.t_two_sided(F.col("t"), F.col("v")).alias("p")).collect():
        assert near(r.p, dist.t_sf2(r.t, r.v)), r


def test_chi2(spark):
    df = spark.createDataFrame(CHI_CASES, "x double, v double")
    for r in df.select("x", "v", tails.chi2_upper(F.col("x"), F.col("v")).alias("p")).collect():
        assert near(r.p, dist.chi2_sf(r.x, r.v)), r


def test_f(spark):
    df = spark.createDataFrame(F_CASES, "f double, a double, b double")
    for r in df.select("f", "a", "b", tails.f_upper(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect():
        assert near(r.p, dist.f_sf(r.f, r.a, r.b)), r


def test_t_quantile(spark):
    cases = [(p, v) for p in (0.025, 0.3, 0.5, 0.6, 0.975, 0.9995) for v in (0.5, 1.0, 3.0, 30.0, 60_000.0, 1e10)]
    df = spark.createDataFrame(cases, "p double, v double")
    for r in df.select("p", "v", tails.t_quantile(F.col("p"), F.col("v")).alias("q")).collect():
        assert r.q == pytest.approx(dist.t_ppf(r.p, r.v), rel=1e-9, abs=1e-12), r


def test_lilliefors(spark):
    df = spark.createDataFrame([(d, n) for n in (4, 5, 20, 100, 101, 5000) for d in (0.001, 0.01, 0.05, 0.1, 0.2, 0.4)], "d double, n long")
    for r in df.select("d", "n", tails.lilliefors_p(F.col("d"), F.col("n")).alias("p")).collect():
        want = dist.lilliefors_p(r.d, r.n)
        assert near(r.p, want) or (math.isnan(r.p) and math.isnan(want)), r


def test_missing_and_invalid(spark):
    df = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0), (float("nan"), 2.0)], "t double, v double")
    t, v = F.col("t"), F.col("v")
    got = df.select(tails.t_two_sided(t, v).alias("t"), tails.chi2_upper(t, v).alias("c"), tails.f_upper(t, v, v).alias("f")).collect()
    assert got[0] == got[1] == (None, None, None)
    assert all(math.isnan(x) for r in got[2:] for x in r)

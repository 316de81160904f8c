"""Tests against hand-computed values and brute-force formulas."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tabkit.functions import dist
from tabkit.functions.normal import norm_cdf, norm_ppf
from tabkit.operators import inference as H


def test_chisq_2x2(spark):
    counts = spark.createDataFrame([("a", "x", 30), ("a", "y", 10), ("b", "x", 12), ("b", "y", 28)],
                                   "r string, c string, n long")
    plain = H.chisq_stats(counts, "r", "c", correct=False).first()
    yates = H.chisq_test(counts, "r", "c", correct=True).first()
    assert plain.statistic == pytest.approx(16.2406, abs=1e-4)
    assert yates.statistic == pytest.approx(14.4862, abs=1e-4)
    assert yates.df == 1
    assert yates.p_value == pytest.approx(dist.chi2_sf(14.4862, 1), rel=1e-4)


def test_norm_functions(spark):
    zs = [-8.0, -3.1, -1.0, -0.2, 0.0, 0.7, 2.5, 6.0]
    ps = [1e-10, 0.001, 0.02, 0.3, 0.5, 0.77, 0.975, 0.9999]
    df = spark.createDataFrame([(z, p) for z, p in zip(zs, ps)], "z double, p double")
    rows = df.select(norm_cdf("z").alias("c"), norm_ppf("p").alias("q")).collect()
    nd = statistics.NormalDist()
    for (z, p), r in zip(zip(zs, ps), rows):
        assert r.c == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=1e-7, abs=1e-15)
        assert r.q == pytest.approx(nd.inv_cdf(p), rel=1e-12)


def test_welch_and_anova(spark):
    a = [5.1, 4.9, 6.2, 5.8, 6.0, 5.5]
    b = [6.5, 7.1, 6.8, 7.4, 6.9]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, y double")
    w = H.welch_test(df, "y", "g", ["a", "b"]).first()
    se = math.sqrt(statistics.variance(a) / 6 + statistics.variance(b) / 5)
    t = (statistics.mean(a) - statistics.mean(b)) / se
    assert w.statistic == pytest.approx(t)
    assert w.p_value == pytest.approx(dist.t_sf2(t, w.df))
    assert w.conf_low < statistics.mean(a) - statistics.mean(b) < w.conf_high
    an = H.anova_test(df, "y", "g").first()
    m = statistics.mean(a + b)
    ssb = 6 * (statistics.mean(a) - m) ** 2 + 5 * (statistics.mean(b) - m) ** 2
    ssw = 5 * statistics.variance(a) + 4 * statistics.variance(b)
    assert an.ss_between == pytest.approx(ssb) and an.ss_within == pytest.approx(ssw)
    assert an.statistic == pytest.approx(ssb / (ssw / 9))
    # two groups: F = t^2 of the pooled test; p-values agree with the F tail
    assert an.p_value == pytest.approx(dist.f_sf(an.statistic, 1, 9))


def _brute_fligner(groups):
    xs, gs = [], []
    for g, vals in groups.items():
        med = statistics.median(vals)
        for v in vals:
            xs.append(abs(v - med))
            gs.append(g)
    n = len(xs)
    order = sorted(range(n), key=lambda i: xs[i])
    ranks = [0.0] * n
    i = 0
    while i < n:
        j = i
        while j + 1 < n and xs[order[j + 1]] == xs[order[i]]:
            j += 1
        for k in range(i, j + 1):
            ranks[order[k]] = (i + j) / 2 + 1
        i = j + 1
    nd = statistics.NormalDist()
    a = [nd.inv_cdf((1 + r / (n + 1)) / 2) for r in ranks]
    stat = sum(sum(a[i] for i in range(n) if gs[i] == g) ** 2 / sum(1 for x in gs if x == g)
               for g in groups)
    return (stat - n * statistics.mean(a) ** 2) / statistics.variance(a)


def test_fligner_and_levene(spark):
    groups = {"a": [1.0, 2.0, 2.0, 4.0, 7.0], "b": [3.0, 3.5, 9.0, 10.0, 1.0, 2.0], "c": [5.0, 5.0, 6.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, y double")
    f = H.fligner_test(df, "y", "g").first()
    assert f.statistic == pytest.approx(_brute_fligner(groups))
    assert f.df == 2
    lv = H.levene_stats(df, "y", "g").first()
    dev = {g: [abs(v - statistics.median(vs)) for v in vs] for g, vs in groups.items()}
    alld = [d for vs in dev.values() for d in vs]
    m = statistics.mean(alld)
    ssb = sum(len(v) * (statistics.mean(v) - m) ** 2 for v in dev.values())
    ssw = sum((len(v) - 1) * statistics.variance(v) for v in dev.values())
    assert lv.statistic == pytest.approx((ssb / 2) / (ssw / (len(alld) - 3)))


def test_lilliefors_statistic(spark):
    xs = [2.1, 3.3, 3.3, 4.0, 5.6, 6.1, 7.7, 8.0, 9.9, 12.5, 13.0, 20.0]
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    r = H.lilliefors_test(df, "x").first()
    m, s, n = statistics.mean(xs), statistics.stdev(xs), len(xs)
    ys = sorted(xs)
    d = 0.0
    for i, v in enumerate(ys):
        c = 0.5 * math.erfc(-((v - m) / s) / math.sqrt(2))
        d = max(d, (i + 1) / n - c, c - i / n)
    assert r.statistic == pytest.approx(d)
    assert r.p_value == pytest.approx(dist.lilliefors_p(d, n))


def test_pearson_spearman(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    b = [2.0, 1.0, 4.0, 3.0, 7.0, 7.0, 6.0]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    p = H.pearson_test(df, "a", "b").first()
    r = statistics.correlation(a, b)
    assert p.estimate == pytest.approx(r)
    t = r * math.sqrt(5 / (1 - r * r))
    assert p.p_value == pytest.approx(dist.t_sf2(t, 5))
    s = H.spearman_test(df, "a", "b").first()
    assert s.estimate == pytest.approx(statistics.correlation(a, b, method="ranked"))


def test_dist_known_values():
    assert dist.t_sf2(2.0, 10) == pytest.approx(0.0733880348, rel=1e-8)
    assert dist.f_sf(3.0, 2, 20) == pytest.approx(1.3 ** -10, rel=1e-10)
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert dist.t_ppf(0.975, 10) == pytest.approx(2.228138852, rel=1e-8)

"""Hand-computed fixtures (FIXTURES.md section 13)."""

import pytest
from pyspark.sql import functions as F

from tabkit.functions import columns as X
from tabkit.operators import describe as D
from tabkit.operators import order as O

XS = [1, 2, 2, 3, 3, 5, 8, 13]


@pytest.fixture(scope="module")
def xdf(spark):
    return spark.createDataFrame([(float(v),) for v in XS], "x double")


def test_describe_column(xdf):
    r = D.describe_column(xdf, "x").first().asDict()
    assert r["n"] == 8
    assert r["mean"] == pytest.approx(4.625)
    assert r["median"] == pytest.approx(3.0)
    assert r["mode"] == 2.0 and r["mode_n"] == 2
    assert r["mid_range"] == pytest.approx(7.0)
    assert r["range"] == pytest.approx(12.0)
    assert (r["q1"], r["q3"]) == (pytest.approx(2.0), pytest.approx(5.75))
    assert r["trimean"] == pytest.approx(3.44)      # 3.4375 rounded half-even to 2
    assert r["iqr"] == pytest.approx(3.75)
    assert r["p40"] == pytest.approx(2.8)
    assert r["var"] == pytest.approx(16.267857, abs=1e-6)
    assert r["trimmed_mean"] == pytest.approx(4.62)  # floor(0.8) = 0 dropped; 4.625 -> 4.62 (half-even)


def test_trimmed_mean_drops_ties_at_boundary(spark):
    # n = 10, trim 0.1 -> drop one value at each end, ties straddle the cut
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 2, 3, 4, 5, 6, 7, 9, 9]], "x double")
    r = D.trimmed_mean(df, "x", 0.1).first()[0]
    assert r == pytest.approx(sum([1, 2, 3, 4, 5, 6, 7, 9]) / 8)


def test_geo_harm_zero_guard(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (8.0,)], "x double")
    r = D.moments(df, "x").first()
    assert r["geo_mean"] == 0.0 and r["harm_mean"] == 0.0
    df2 = spark.createDataFrame([(2.0,), (8.0,)], "x double")
    r2 = D.moments(df2, "x").first()
    assert r2["geo_mean"] == pytest.approx(4.0)
    assert r2["harm_mean"] == pytest.approx(3.2)


def test_kurtosis_sample_sd(xdf):
    import statistics
    m = statistics.mean(XS)
    s = statistics.stdev(XS)
    expect = sum((v - m) ** 4 for v in XS) / len(XS) / s ** 4 - 3
    assert D.moments(xdf, "x").first()["kurtosis"] == pytest.approx(expect)


def test_cut_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [100.0, 810.0, 810.01, 1620.0, 8000.0, 8001.0]], "x double")
    out = df.select(X.cut("x", [100, 810, 1620, 8000], ["bajo", "medio", "alto"]).alias("c")).collect()
    assert [r.c for r in out] == [None, "bajo", "medio", "medio", "alto", None]


def test_frequency_table_null_last(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    rows = O.frequency_table(df, "v").orderBy("cum_n").collect()
    assert [(r.v, r.n, r.cum_n) for r in rows] == [("a", 2, 2), ("b", 1, 3), (None, 1, 4)]
    assert rows[-1].cum_p == pytest.approx(100.0)


def test_running_sum_many_partitions(spark):
    # running sum across 16 range partitions equals the plain prefix sum
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("v"), F.lit(1).alias("w"))
    rs = O.running_sum(df, "w", ["v"], out_col="c", partitions=16).orderBy("v").collect()
    assert [r.c for r in rs] == list(range(1, 5001))


def test_level_counts_keep_zero(spark):
    df = spark.createDataFrame([("bajo",), ("bajo",), (None,)], "c string")
    rows = D.level_counts(df, "c", ["bajo", "medio", "alto"]).orderBy("level_no").collect()
    assert [(r.c, r.n) for r in rows] == [("bajo", 2), ("medio", 0), ("alto", 0)]


def test_missing(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    assert D.missing_total(df).first()[0] == 3
    pats = {tuple(r[:2]): r.n for r in D.missing_patterns(df).collect()}
    assert pats == {(False, True): 1, (True, True): 1, (False, False): 1}


def test_mid_rank_with_hot_value_salted(spark):
    # one value on most rows: salted join-back gives the same ranks
    rows = [(0.0,)] * 300 + [(float(v),) for v in range(1, 41)]
    df = spark.createDataFrame(rows, "x double")
    plain = O.with_mid_rank(df, "x", hot_rows=10**9).groupBy("x", "rank").count().collect()
    salted = O.with_mid_rank(df, "x", hot_rows=50, salt_buckets=7).groupBy("x", "rank").count().collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, salted))
    ranks = {r.x: r.rank for r in plain}
    assert ranks[0.0] == pytest.approx(150.5) and ranks[1.0] == 301.0


def test_running_sum_window_is_partitioned(spark):
    from tabkit.plans.checks import plan_text
    df = spark.range(0, 1000).select((F.col("id") % 97).alias("v"), F.lit(1).alias("w"))
    txt = plan_text(O.running_sum(df, "w", ["v"], out_col="c"))
    # the running window is keyed by the range-partition id, never global
    assert "windowspecdefinition(_pid" in txt


def test_order_positions_chunked(spark):
    rows = [(5.0,)] * 23 + [(1.0,)] * 4 + [(9.0,)]
    df = spark.createDataFrame(rows, "x double")
    got = sorted((r.x, r.i) for r in O.order_positions(df, "x", chunk=5).collect())
    assert got == sorted([(1.0, i) for i in range(1, 5)] + [(5.0, i) for i in range(5, 28)] + [(9.0, 28)])

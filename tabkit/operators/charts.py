"""Aggregated tables behind the usual charts (drawing is out of scope):
histogram counts/density, normal overlay, Q-Q points and line, box-plot
statistics with outliers, scatter projections, level grids."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabkit.functions.normal import norm_ppf
from tabkit.operators.describe import quantiles
from tabkit.operators.order import _list, join_on_keys, order_positions, ranked_values
from tabkit.plans.scalars import with_one_row
from tabkit.plans.sizing import broadcast_if_bounded


def histogram(df: DataFrame, col: str, bins: int = 10, fill: str | None = None,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width bins over [lo, hi] (data range by default; the top edge
    belongs to the last bin). ``(fill?, bin, left, right, mid, n, density)``
    with density = n / (N * width), N = non-null rows of the fill group."""
    keys = _list(fill)
    src = df.where(F.col(col).isNotNull())
    rng = src.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    if lo is not None:
        rng = rng.withColumn("_lo", F.lit(float(lo)))
    if hi is not None:
        rng = rng.withColumn("_hi", F.lit(float(hi)))
    rng = rng.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    j = with_one_row(src, rng)
    # a constant column has no width: all its rows are in the first bin
    at = F.coalesce(F.floor(F.try_divide(F.col(col) - F.col("_lo"), F.col("_w"))), F.lit(0))
    b = F.least(at + 1, F.lit(bins)).cast("int")
    j = j.where((F.col(col) >= F.col("_lo")) & (F.col(col) <= F.col("_hi"))).withColumn("bin", b)
    cnt = j.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"),
                                      F.first("_lo").alias("_lo"), F.first("_w").alias("_w"))
    tot = cnt.groupBy(*keys).agg(F.sum("n").alias("_N"))
    out = join_on_keys(cnt, tot, keys)
    left = F.col("_lo") + (F.col("bin") - 1) * F.col("_w")
    return out.select(*keys, "bin", left.alias("left"), (left + F.col("_w")).alias("right"),
                      (left + F.col("_w") / 2).alias("mid"), F.col("n").cast("bigint").alias("n"),
                      F.try_divide(F.col("n"), F.col("_N") * F.col("_w")).alias("density"))


def normal_overlay(hist: DataFrame, df: DataFrame, col: str, x_col: str = "mid") -> DataFrame:
    """Adds ``normal_density`` at ``x_col`` for N(mean, sd) of ``col``
    (NULLs skipped)."""
    st = df.agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    j = with_one_row(hist, st)
    z = F.try_divide(F.col(x_col) - F.col("_mu"), F.col("_sd"))
    return j.withColumn("normal_density", F.try_divide(F.exp(-z * z / 2), F.col("_sd") * math.sqrt(2 * math.pi))) \
        .drop("_mu", "_sd")


def qq_positions(df: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """``(keys..., i, plotting_position, sample)``, one row per non-null row:
    ``(i - a)/(n + 1 - 2a)`` (a = 3/8 for n <= 10, else 1/2) and the value."""
    keys = _list(keys)
    pos = order_positions(df, col, keys)
    a = F.when(F.col("total") <= 10, F.lit(3.0 / 8)).otherwise(F.lit(0.5))
    return pos.select(*keys, F.col("i").cast("bigint").alias("i"),
                      ((F.col("i") - a) / (F.col("total") + 1 - 2 * a)).alias("plotting_position"), F.col(col).alias("sample"))


def qq_points(df: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """One point per non-null row: theoretical N(0,1) quantile of its
    plotting position against the sample value."""
    keys = _list(keys)
    return qq_positions(df, col, keys).select(*keys, "i", norm_ppf(F.col("plotting_position")).alias("theoretical"), "sample")


def qq_line(df: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Line through the first and third quartile points (R ``qqline``)."""
    keys = _list(keys)
    q = quantiles(df, col, [0.25, 0.75], keys, ["q1", "q3"])
    z1 = -0.6744897501960817
    slope = (F.col("q3") - F.col("q1")) / (2 * -z1)
    return q.select(*keys, slope.alias("slope"), (F.col("q1") - slope * z1).alias("intercept"))


def fivenum(df: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Tukey's five numbers (min, lower hinge, median, upper hinge, max)."""
    return fivenum_ranked(ranked_values(df, col, _list(keys)), col, keys)


def fivenum_ranked(r: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """``fivenum`` of a column that is ranked already (``ranked_values``)."""
    keys = _list(keys)
    n = F.col("total")
    n4 = F.floor((n + 3) / 2) / 2
    pos = {"min": F.lit(1.0), "lower_hinge": n4, "median": (n + 1) / 2,
           "upper_hinge": n + 1 - n4, "max": n.cast("double")}
    aggs = []
    for name, d in pos.items():
        for side, e in (("lo", F.floor(d)), ("hi", F.ceil(d))):
            inside = (F.col("before") < e) & (e <= F.col("cum_n"))
            aggs.append(F.max(F.when(inside, F.col(col))).alias(f"_{name}_{side}"))
    g = r.groupBy(*keys).agg(*aggs, F.first("total").cast("bigint").alias("n"))
    return g.select(*keys, "n", *[((F.col(f"_{k}_lo") + F.col(f"_{k}_hi")) / 2).alias(k) for k in pos])


def box_stats(df: DataFrame, value: str, group: str | None = None, coef: float = 1.5):
    """Box-plot statistics per group and the outliers.

    Returns ``(stats, outliers)``: stats has hinges, median, whisker ends
    (most extreme values within ``coef`` hinge spreads) and the number of
    outliers; outliers lists ``(group, value, n)`` for values beyond."""
    keys = _list(group)
    ranked = ranked_values(df, value, keys)     # checkpointed: ranked once, read three times
    fv = fivenum_ranked(ranked, value, keys)
    r = ranked.select(*keys, value, "n")
    hinges = fv.drop("n", "median")
    if keys:
        hinges, _ = broadcast_if_bounded(hinges)   # one row per group
    j = join_on_keys(r, hinges, keys)
    spread = coef * (F.col("upper_hinge") - F.col("lower_hinge"))
    inside = (F.col(value) >= F.col("lower_hinge") - spread) & (F.col(value) <= F.col("upper_hinge") + spread)
    w = j.groupBy(*keys).agg(F.min(F.when(inside, F.col(value))).alias("whisker_low"),
                             F.max(F.when(inside, F.col(value))).alias("whisker_high"),
                             F.sum(F.when(~inside, F.col("n")).otherwise(0)).cast("bigint").alias("n_outliers"))
    stats = join_on_keys(fv, w, keys)
    outliers = j.where(~inside).select(*keys, value, F.col("n").cast("bigint").alias("n"))
    return stats, outliers


def scatter(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    cols = [x, y] + ([color] if color else [])
    return df.select(*cols).where(F.col(x).isNotNull() & F.col(y).isNotNull())

"""Classical tests as distributed aggregates.

Each test reduces the table to a few numbers per group with one or two
aggregations (counts, means, variances, ranks from the frequency table);
the p-value is then a column expression over that one-row-per-group result
(``functions/tails.py``): no Python worker and no data on the driver.
Output: one row per group with ``statistic``, degrees of freedom,
``p_value`` and the test's estimates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabkit.functions import tails
from tabkit.functions.normal import norm_cdf, norm_ppf
from tabkit.operators.describe import quantiles
from tabkit.operators.order import _list, join_on_keys, ranked_counts, ranked_values
from tabkit.plans.scalars import with_one_row
from tabkit.plans.sizing import broadcast_if_bounded
from tabkit.plans.skew import salted_join
from tabkit.session import checkpoint_dir


def _z(conf: float) -> float:
    from statistics import NormalDist
    return NormalDist().inv_cdf(0.5 + conf / 2)


def _corr(a, b):
    """Pearson r over the rows where both are set; NULL where one has no spread."""
    a, b = F.col(a), F.col(b)
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def _r_to_t(r, n):
    """t of a correlation; infinite (p = 0) at r = 1 or -1, NULL without
    degrees of freedom or spread."""
    t = F.when(F.abs(r) >= 1, F.signum(r) * F.lit(float("inf"))).otherwise(
        r * F.sqrt(F.try_divide(n - 2, 1 - r * r)))
    return F.when(n > 2, t)


# ---- correlation -------------------------------------------------------------

def pearson_stats(df: DataFrame, a: str, b: str, keys: Sequence[str] | None = None,
                  conf: float = 0.95) -> DataFrame:
    """r, t = r sqrt((n-2)/(1-r^2)), df = n-2 and the Fisher-z interval."""
    keys = _list(keys)
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    g = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _corr(a, b).alias("r"))
    r, n = F.col("r"), F.col("n")
    half = F.try_divide(F.lit(_z(conf)), F.sqrt(n - 3))
    return g.select(
        *keys, n.cast("bigint").alias("n"), r.alias("estimate"),
        _r_to_t(r, n).alias("statistic"),
        (n - 2).cast("bigint").alias("df"),
        F.when(n > 3, F.tanh(F.atanh(r) - half)).alias("conf_low"),
        F.when(n > 3, F.tanh(F.atanh(r) + half)).alias("conf_high"))


def pearson_test(df: DataFrame, a: str, b: str, keys=None, conf: float = 0.95) -> DataFrame:
    s = pearson_stats(df, a, b, keys, conf)
    return s.withColumn("p_value", tails.t_two_sided(F.col("statistic"), F.col("df").cast("double")))


def spearman_stats(df: DataFrame, a: str, b: str, hot_rows: int = 1_000_000) -> DataFrame:
    """``n, estimate (rho), statistic (S), t, df`` of Spearman's rank correlation."""
    return _spearman(df, a, b, hot_rows).drop("ties")


def _spearman(df: DataFrame, a: str, b: str, hot_rows: int = 1_000_000) -> DataFrame:
    """rho = Pearson correlation of tie-averaged ranks; S = (n^3-n)(1-rho)/6.

    The table is read once, into counts of its distinct pairs; both columns
    are ranked from these counts, and the correlation is weighted by them.
    ``ties``: some value of a column occurs more than once."""
    checkpoint_dir(df.sparkSession)
    pairs = (df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("_a"), F.col(b).alias("_b"))
             .agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True))
    joined = pairs
    for c in ("_a", "_b"):
        ranks = ranked_counts(pairs.groupBy(c).agg(F.sum("_c").alias("n")), c)
        centred = ranks.select(c, (F.col("mid_rank") - (F.col("total") + 1) / 2.0).alias(f"_r{c}"), (F.col("n") > 1).alias(f"_t{c}"))
        hot = pairs.groupBy(c).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= hot_rows).select(c)
        joined = salted_join(joined, centred, [c], "inner", hot_rows, hot=hot)
    x, y, w = F.col("_r_a"), F.col("_r_b"), F.col("_c")
    g = joined.agg(F.sum(w).alias("n"), F.sum(w * x * y).alias("_xy"), F.sum(w * x * x).alias("_xx"), F.sum(w * y * y).alias("_yy"),
                   F.coalesce(F.bool_or(F.col("_t_a") | F.col("_t_b")), F.lit(False)).alias("ties"))
    g = g.select("ties", F.coalesce("n", F.lit(0)).alias("n"), F.try_divide(F.col("_xy"), F.sqrt("_xx") * F.sqrt("_yy")).alias("rho"))
    n, rho = F.col("n").cast("double"), F.col("rho")
    return g.select(F.col("n").cast("bigint").alias("n"), rho.alias("estimate"),
                    ((n * n * n - n) * (1 - rho) / 6).alias("statistic"),
                    _r_to_t(rho, n).alias("t"),
                    (F.col("n") - 2).cast("bigint").alias("df"), "ties")


def spearman_test(df: DataFrame, a: str, b: str, exact: bool = False) -> DataFrame:
    """With the two-sided ``p_value`` of t. ``exact``: of the rank statistic
    itself, below ``tails.RANK_SERIES`` rows without ties; of t elsewhere."""
    s = _spearman(df, a, b)
    p = tails.t_two_sided(F.col("t"), F.col("df").cast("double"))
    if exact:
        small = ~F.col("ties") & (F.col("n") < tails.RANK_SERIES)
        p = F.when(small, tails.spearman_two_sided(F.col("statistic"), F.col("n").cast("double"))).otherwise(p)
    return s.withColumn("p_value", p).drop("ties")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs of columns in one aggregate pass: long
    ``(var1, var2, n, r, t, df, p_value)``, var1 < var2 by position."""
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    aggs = []
    for i, (x, y) in enumerate(pairs):
        ok = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggs += [_corr(x, y).alias(f"r{i}"), F.sum(ok.cast("bigint")).alias(f"n{i}")]
    a = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"),
                              F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r"))
                     for i, (x, y) in enumerate(pairs)])
    out = a.select(F.inline(rows))
    n, r = F.col("n"), F.col("r")
    out = out.select("var1", "var2", "n", "r", _r_to_t(r, n).alias("t"),
                     (n - 2).alias("df"))
    return out.withColumn("p_value", tails.t_two_sided(F.col("t"), F.col("df").cast("double")))


# ---- chi-squared ---------------------------------------------------------------

def chisq_stats(counts: DataFrame, row: str, col: str, n_col: str = "n",
                correct: bool = True) -> DataFrame:
    """Pearson's chi-squared from a long contingency table (zero cells must
    be present). Yates' continuity correction on 2x2 tables when
    ``correct`` (R's default): ``c = min(0.5, min |O - E|)``."""
    rt = counts.groupBy(row).agg(F.sum(n_col).alias("_rt"))
    ct = counts.groupBy(col).agg(F.sum(n_col).alias("_ct"))
    e = counts.join(rt, row).join(ct, col)
    tot = counts.agg(F.sum(n_col).alias("_N"),
                     F.countDistinct(row).alias("_r"), F.countDistinct(col).alias("_c"))
    e = with_one_row(e, tot).withColumn("_E", F.col("_rt") * F.col("_ct") / F.col("_N"))
    e = e.withColumn("_d", F.abs(F.col(n_col) - F.col("_E")))
    cells = e.agg(F.min("_d").alias("_dmin"), F.first("_r").alias("_r"), F.first("_c").alias("_c"))
    e = with_one_row(e, cells.select("_dmin"), "_one2")
    yates = (F.lit(correct) & (F.col("_r") == 2) & (F.col("_c") == 2))
    corr = F.when(yates, F.least(F.lit(0.5), F.col("_dmin"))).otherwise(F.lit(0.0))
    return e.agg(F.sum(F.try_divide(F.pow(F.col("_d") - corr, 2), F.col("_E"))).alias("statistic"),
                 ((F.first("_r") - 1) * (F.first("_c") - 1)).cast("bigint").alias("df"))


def chisq_test(counts: DataFrame, row: str, col: str, n_col: str = "n", correct: bool = True) -> DataFrame:
    s = chisq_stats(counts, row, col, n_col, correct)
    return s.withColumn("p_value", tails.chi2_upper(F.col("statistic"), F.col("df").cast("double")))


# ---- two-sample t, ANOVA and variance homogeneity ------------------------------

def welch_stats(df: DataFrame, value: str, group: str, levels: Sequence) -> DataFrame:
    """Welch two-sample t (unpaired, unequal variances), x = first level."""
    x0, x1 = levels
    v = F.col(value)
    g = df.agg(*[e for i, lv in enumerate((x0, x1)) for e in (
        F.count(F.when(F.col(group) == lv, v)).alias(f"n{i}"),
        F.avg(F.when(F.col(group) == lv, v)).alias(f"m{i}"),
        F.var_samp(F.when(F.col(group) == lv, v)).alias(f"s{i}"))])
    se0, se1 = F.try_divide(F.col("s0"), F.col("n0")), F.try_divide(F.col("s1"), F.col("n1"))
    se = F.sqrt(se0 + se1)
    dfw = F.try_divide(F.pow(se0 + se1, 2), F.try_divide(F.pow(se0, 2), F.col("n0") - 1)
                       + F.try_divide(F.pow(se1, 2), F.col("n1") - 1))
    return g.select(F.col("m0").alias("mean_x"), F.col("m1").alias("mean_y"),
                    F.try_divide(F.col("m0") - F.col("m1"), se).alias("statistic"),
                    dfw.alias("df"), se.alias("stderr"),
                    F.col("n0").cast("bigint").alias("n_x"), F.col("n1").cast("bigint").alias("n_y"))


def welch_test(df: DataFrame, value: str, group: str, levels: Sequence, conf: float = 0.95) -> DataFrame:
    s = welch_stats(df, value, group, levels)
    q = tails.t_quantile(F.lit(0.5 + conf / 2), F.col("df"))
    diff = F.col("mean_x") - F.col("mean_y")
    return (s.withColumn("p_value", tails.t_two_sided(F.col("statistic"), F.col("df")))
            .withColumn("_q", q)
            .withColumn("conf_low", diff - F.col("_q") * F.col("stderr"))
            .withColumn("conf_high", diff + F.col("_q") * F.col("stderr")).drop("_q"))


def anova_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way ANOVA table in one row: SS, df, MS, F."""
    per = (df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
           .groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"),
                               F.var_samp(value).alias("s2")))
    tot = per.agg(F.sum("n").alias("_N"), F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("_M"),
                  F.count(F.lit(1)).alias("_k"))
    j = with_one_row(per, tot)
    a = j.agg(F.sum(F.col("n") * F.pow(F.col("m") - F.col("_M"), 2)).alias("ss_between"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("s2"), F.lit(0.0))).alias("ss_within"),
              (F.first("_k") - 1).cast("bigint").alias("df_between"),
              (F.first("_N") - F.first("_k")).cast("bigint").alias("df_within"))
    ms_b = F.try_divide(F.col("ss_between"), F.col("df_between"))
    ms_w = F.try_divide(F.col("ss_within"), F.col("df_within"))
    f = F.when((ms_w == 0) & (ms_b > 0), F.lit(float("inf"))).otherwise(F.try_divide(ms_b, ms_w))
    return a.select("df_between", "df_within", "ss_between", "ss_within",
                    ms_b.alias("ms_between"), ms_w.alias("ms_within"), f.alias("statistic"))


def anova_test(df: DataFrame, value: str, group: str) -> DataFrame:
    s = anova_stats(df, value, group)
    return s.withColumn("p_value", tails.f_upper(F.col("statistic"), F.col("df_between").cast("double"),
                                                 F.col("df_within").cast("double")))


def _abs_dev_from_median(df: DataFrame, value: str, group: str) -> DataFrame:
    src = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(group, value)
    med, _ = broadcast_if_bounded(quantiles(src, value, [0.5], [group], ["_med"]))
    return src.join(med, group).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))


def levene_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Brown-Forsythe/Levene: ANOVA F on |y - group median|."""
    return anova_stats(_abs_dev_from_median(df, value, group), "_dev", group)


def levene_test(df: DataFrame, value: str, group: str) -> DataFrame:
    return anova_test(_abs_dev_from_median(df, value, group), "_dev", group)


def fligner_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Fligner-Killeen (median-centred): a = qnorm((1 + rank|x - med| / (n+1)) / 2),
    statistic = (sum_j S_j^2 / n_j - n * mean(a)^2) / var(a), df = k - 1."""
    dev = _abs_dev_from_median(df, value, group)
    checkpoint_dir(df.sparkSession)
    counts = dev.groupBy(group, "_dev").agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True)  # one pass for ranks and sums
    ranks = ranked_counts(counts.groupBy("_dev").agg(F.sum("_c").alias("n")), "_dev").select("_dev", "mid_rank", "total")
    a, c = F.col("_a"), F.col("_c")
    per = (counts.join(ranks, "_dev")
           .withColumn("_a", norm_ppf((1 + F.col("mid_rank") / (F.col("total") + 1)) / 2))
           .groupBy(group).agg(F.sum(c * a).alias("S"), F.sum(c * a * a).alias("S2"), F.sum(c).alias("nj")))
    glob = per.agg(F.sum("nj").alias("n"), F.sum("S").alias("_s"), F.sum("S2").alias("_s2")).select(
        "n", F.try_divide(F.col("_s"), F.col("n")).alias("abar"),
        F.try_divide(F.col("_s2") - F.try_divide(F.col("_s") * F.col("_s"), F.col("n")), F.col("n") - 1).alias("va"))
    j = with_one_row(per, glob)
    return j.agg(F.try_divide(F.sum(F.col("S") * F.col("S") / F.col("nj"))
                              - F.first("n") * F.pow(F.first("abar"), 2), F.first("va")).alias("statistic"),
                 (F.count(F.lit(1)) - 1).cast("bigint").alias("df"))


def fligner_test(df: DataFrame, value: str, group: str) -> DataFrame:
    s = fligner_stats(df, value, group)
    return s.withColumn("p_value", tails.chi2_upper(F.col("statistic"), F.col("df").cast("double")))


# ---- normality -------------------------------------------------------------------

def lilliefors_stats(df: DataFrame, value: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Kolmogorov-Smirnov D against N(mean, sd) with estimated parameters,
    per group, from the ranked distinct values (ECDF just below and at each
    value) -- exact, no per-row sort."""
    keys = _list(keys)
    src = df.where(F.col(value).isNotNull())
    mom = src.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_sd"))
    r = ranked_values(src, value, keys)
    # one row per group, size-checked broadcast: the ranked table (one row
    # per distinct value) is never shuffled by group, so a hot group with
    # many distinct values does not land in one task
    if keys:
        mom, _ = broadcast_if_bounded(mom)
    j = join_on_keys(r, mom, keys)
    phi = norm_cdf(F.try_divide(F.col(value) - F.col("_m"), F.col("_sd")))
    d = F.when(F.col("_sd") > 0, F.greatest(F.col("cum_n") / F.col("total") - phi,
                                            phi - F.col("before") / F.col("total")))
    return j.groupBy(*keys).agg(F.max(d).alias("statistic"),
                                F.first("total").cast("bigint").alias("n"))


def lilliefors_test(df: DataFrame, value: str, keys: Sequence[str] | None = None) -> DataFrame:
    s = lilliefors_stats(df, value, keys)
    return s.withColumn("p_value", tails.lilliefors_p(F.col("statistic"), F.col("n").cast("double")))

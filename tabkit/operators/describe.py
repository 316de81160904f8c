"""Descriptive statistics, frequency and contingency tables.

Moments come from one fused aggregate; order statistics (quantiles, mode,
trimmed mean) from the frequency table of ``tabkit.operators.order`` so
they are exact and never gather a group's values on one task.
Every function takes optional group ``keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabkit.operators.order import _list, join_on_keys, ranked_values, value_counts


def moments(df: DataFrame, col: str, keys: Sequence[str] | None = None,
            digits: int = 2) -> DataFrame:
    """One row per group: count, nulls, mean, min, max, mid-range, range,
    var/sd (n-1), coefficient of variation %, geometric and harmonic means
    (rounded half-even to ``digits``), excess kurtosis ``m4/s^4 - 3`` with
    the sample s, and the population form ``m4/m2^2 - 3``."""
    keys = _list(keys)
    x = F.col(col)
    n = F.count(x)
    g = df.groupBy(*keys).agg(
        n.alias("n"),
        F.sum(F.when(x.isNull(), 1).otherwise(0)).alias("nulls"),
        F.avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.var_samp(x).alias("var"),
        F.stddev_samp(x).alias("sd"),
        F.avg(F.ln(F.when(x > 0, x))).alias("_mlog"),
        F.avg(F.try_divide(F.lit(1.0), x)).alias("_minv"),
        F.kurtosis(x).alias("kurtosis_pop"),
    )
    nn = F.col("n").cast("double")
    geo = (F.when(F.col("min") < 0, F.lit(None)).when(F.col("min") == 0, F.lit(0.0))
           .otherwise(F.exp("_mlog")))
    harm = F.when(F.col("min") == 0, F.lit(0.0)).otherwise(F.try_divide(F.lit(1.0), F.col("_minv")))
    return g.select(
        *keys, F.col("n").cast("bigint").alias("n"), F.col("nulls").cast("bigint").alias("nulls"),
        "mean", "min", "max",
        ((F.col("min") + F.col("max")) / 2).alias("mid_range"),
        (F.col("max") - F.col("min")).alias("range"),
        "var", "sd",
        (F.try_divide(F.col("sd"), F.col("mean")) * 100).alias("cv_pct"),
        F.bround(geo, digits).alias("geo_mean"),
        F.bround(harm, digits).alias("harm_mean"),
        ((F.col("kurtosis_pop") + 3) * F.pow(1 - F.try_divide(F.lit(1.0), nn), 2) - 3).alias("kurtosis"),
        "kurtosis_pop",
    )


def _quantiles_ranked(r: DataFrame, col: str, probs, keys, names) -> DataFrame:
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("total") - 1) * float(p) + 1
        lo, hi = F.floor(h), F.ceil(h)
        in_lo = (F.col("before") < lo) & (lo <= F.col("cum_n"))
        in_hi = (F.col("before") < hi) & (hi <= F.col("cum_n"))
        aggs += [F.max(F.when(in_lo, F.col(col))).alias(f"_{name}_lo"),
                 F.max(F.when(in_hi, F.col(col))).alias(f"_{name}_hi"),
                 F.max(h - lo).alias(f"_{name}_f")]
    g = r.groupBy(*keys).agg(*aggs)
    outs = [(F.col(f"_{n}_lo") + F.col(f"_{n}_f") * (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))).alias(n)
            for n in names]
    return g.select(*keys, *outs)


def quantiles(df: DataFrame, col: str, probs: Sequence[float],
              keys: Sequence[str] | None = None, names: Sequence[str] | None = None,
              partitions: int | None = None, approx: float | None = None) -> DataFrame:
    """Exact type-7 quantiles (linear interpolation between order
    statistics), one row per group with one column per probability.

    ``approx`` is a rank error: each answer is then a value of the column
    whose rank is at most ``approx * n`` from the wanted one, from a mergeable
    sketch of about ``1 / approx`` values, in one aggregate without ranks."""
    keys = _list(keys)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    if approx is not None:
        g = df.groupBy(*keys).agg(sketch_quantiles(col, probs, approx).alias("_q"))
        return g.select(*keys, *(F.col("_q")[i].alias(n) for i, n in enumerate(names)))
    return _quantiles_ranked(ranked_values(df, col, keys, partitions), col, probs, keys, names)


def sketch_quantiles(col: str, probs: Sequence[float], error: float):
    """Aggregate: the list of approximate quantiles with a rank error of at
    most ``error`` (a share of the rows)."""
    if not 0 < error < 1:
        raise ValueError("the rank error is a share between 0 and 1")
    return F.percentile_approx(F.col(col).cast("double"), [float(p) for p in probs], int(1 / error) + 1)


def _mode_counts(vc: DataFrame, col: str, keys) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(col).alias("v")))
    return vc.groupBy(*keys).agg(best.alias("_b")).select(
        *keys, F.col("_b.v").alias("mode"), (-F.col("_b.neg_n")).cast("bigint").alias("mode_n"))


def mode(df: DataFrame, col: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Most frequent non-null value; ties -> the lowest value."""
    keys = _list(keys)
    return _mode_counts(value_counts(df, col, keys, drop_null=True), col, keys)


def _trimmed_ranked(r: DataFrame, col: str, trim: float, keys) -> DataFrame:
    g = F.floor(F.col("total") * float(trim))
    kept = F.greatest(F.lit(0), F.least(F.col("cum_n"), F.col("total") - g)
                      - F.greatest(F.col("before"), g))
    return r.groupBy(*keys).agg(F.try_divide(F.sum(kept * F.col(col)), F.sum(kept)).alias("trimmed_mean"))


def trimmed_mean(df: DataFrame, col: str, trim: float = 0.1,
                 keys: Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Mean after dropping ``floor(n * trim)`` values from each end. Each
    distinct value keeps ``max(0, min(cum, n-g) - max(before, g))`` copies."""
    keys = _list(keys)
    return _trimmed_ranked(ranked_values(df, col, keys, partitions), col, trim, keys)


def describe_column(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                    trim: float = 0.1, digits: int = 2) -> DataFrame:
    """All central-tendency and dispersion measures of one column in one
    row per group (mean, median, mode, mid-range, geometric/harmonic/trimmed
    means, trimean, quartiles, P40, IQR, var, sd, CV, kurtosis)."""
    keys = _list(keys)
    m = moments(df, col, keys, digits)
    r = ranked_values(df, col, keys)  # one checkpointed ranked table for all
    q = _quantiles_ranked(r, col, [0.25, 0.4, 0.5, 0.75], keys, ["q1", "p40", "median", "q3"])
    md = _mode_counts(r, col, keys)
    tm = _trimmed_ranked(r, col, trim, keys)
    out = join_on_keys(m, q, keys, "left")
    out = join_on_keys(out, md, keys, "left")
    out = join_on_keys(out, tm, keys, "left")
    return out.select(
        "*",
        F.bround((F.col("q1") + 2 * F.col("median") + F.col("q3")) / 4, digits).alias("trimean"),
        (F.col("q3") - F.col("q1")).alias("iqr"),
    ).withColumn("trimmed_mean", F.bround("trimmed_mean", digits))


def _numeric(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols else [f.name for f in df.schema.fields
                                    if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "decimal")]


def _measures(df: DataFrame, cols: Sequence[str], aggs: dict, quantile_names: Sequence[str], approx: float | None) -> DataFrame:
    """``(column, measures...)``, one row per column, from one wide aggregate
    over the table (no row is multiplied by the columns). Quantiles join it
    as sketches, or exactly, each column ranked from its own value counts."""
    wide = [make(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(cols) for name, make in aggs.items()]
    names = list(aggs)
    if approx is not None:
        wide += [sketch_quantiles(c, [0.25, 0.5, 0.75], approx).alias(f"_q_{i}") for i, c in enumerate(cols)]
    one = df.agg(*wide)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *(F.col(f"{n}_{i}").alias(n) for n in names),
                              *([F.col(f"_q_{i}")[j].alias(q) for j, q in enumerate(quantile_names)] if approx is not None else []))
                     for i, c in enumerate(cols)])
    out = one.select(F.inline(rows))
    if approx is not None:
        return out
    exact = None
    for c in cols:
        q = quantiles(df.select(F.col(c).cast("double").alias("value")), "value", [0.25, 0.5, 0.75], names=quantile_names)
        q = q.select(F.lit(c).alias("column"), *quantile_names)
        exact = q if exact is None else exact.unionByName(q)
    return out.join(exact, "column", "left")


def summary_table(df: DataFrame, cols: Sequence[str] | None = None, approx: float | None = None) -> DataFrame:
    """Six-number summary + NULL count per column, long format
    ``(column, min, q1, median, mean, q3, max, nulls)``. ``approx``: the rank
    error of sketched quartiles, all columns in one pass."""
    aggs = {"min": F.min, "mean": F.avg, "max": F.max, "nulls": lambda x: F.count_if(x.isNull()).cast("bigint")}
    return _measures(df, _numeric(df, cols), aggs, ["q1", "median", "q3"], approx).select("column", "min", "q1", "median", "mean", "q3", "max", "nulls")


def describe_table(df: DataFrame, cols: Sequence[str] | None = None, approx: float | None = None) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max per numeric column (long).
    ``approx``: the rank error of sketched quartiles, all columns in one pass."""
    aggs = {"count": lambda x: F.count(x).cast("bigint"), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return _measures(df, _numeric(df, cols), aggs, ["p25", "p50", "p75"], approx).select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def is_missing(df: DataFrame, col: str):
    """NULL, or NaN in a floating column (``is.na`` is true of both)."""
    c = F.col(f"`{col}`")
    return c.isNull() | F.isnan(c) if df.schema[col].dataType.typeName() in ("double", "float") else c.isNull()


def missing_total(df: DataFrame) -> DataFrame:
    """Total NULL or NaN cells of the table (one row; 0 for an empty table)."""
    return df.agg(sum((F.count_if(is_missing(df, c)) for c in df.columns),
                      F.lit(0).cast("bigint")).alias("missing_cells"))


def missing_share(df: DataFrame) -> DataFrame:
    """Share of NULL or NaN cells per column, long ``(column, missing, share)``."""
    a = df.agg(*[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
               F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(df.columns)])
    return a.select(F.inline(pairs), "_n").select(
        "column", "missing", F.try_divide(F.col("missing"), F.col("_n")).alias("share"))


def missing_patterns(df: DataFrame) -> DataFrame:
    """Rows per combination of missing columns: one boolean column per
    input column (``<col>_missing``) and ``n``."""
    flags = [is_missing(df, c).alias(f"{c}_missing") for c in df.columns]
    return df.select(*flags).groupBy(*[f"{c}_missing" for c in df.columns]) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def count_non_null_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value of ``col`` (``groupby(c)[c].count()``)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def level_counts(df: DataFrame, col: str, levels: Sequence) -> DataFrame:
    """Counts per declared level, zero levels kept, NULL and undeclared
    values dropped (``table(factor)``). ``level_no`` is the 1-based level."""
    spark = df.sparkSession
    lv = spark.createDataFrame([(i + 1, v) for i, v in enumerate(levels)], f"level_no int, {col} {df.schema[col].dataType.simpleString()}") \
        if not isinstance(levels, DataFrame) else levels
    c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(lv).join(c, col, "left").select(
        "level_no", col, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def contingency(df: DataFrame, row: str, col: str, row_levels: Sequence, col_levels: Sequence) -> DataFrame:
    """Two-way table, long ``(row, col, n)`` with zero cells kept."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(r, c) for r in row_levels for c in col_levels], [row, col])
    cnt = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col) \
        .agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(grid).join(cnt, [row, col], "left").select(
        row, col, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def contingency_wide(df: DataFrame, row: str, col: str, col_levels: Sequence) -> DataFrame:
    """Pivoted two-way table (one column per level of ``col``)."""
    return (df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(col_levels))
            .count().na.fill(0))


def group_means(df: DataFrame, value: str, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.avg(value).alias("mean"))


def column_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean and sample variance of every column, long ``(column, mean, var)``."""
    cols = list(cols) if cols else df.columns
    a = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
               *[F.var_samp(c).alias(f"v_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("mean"),
                               F.col(f"v_{i}").alias("var")) for i, c in enumerate(cols)])
    return a.select(F.inline(pairs))


def profile_by(df: DataFrame, group: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every column per group (cluster profile)."""
    cols = [c for c in (cols or df.columns) if c != group]
    return df.groupBy(group).agg(*[F.avg(c).alias(c) for c in cols])


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)`` of a table, one row."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")) \
        .withColumn("columns", F.lit(len(df.columns)).cast("bigint"))

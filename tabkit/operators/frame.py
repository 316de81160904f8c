"""Whole-frame reshaping helpers: drop the id column, coerce to numeric,
drop incomplete rows, data-driven binning, random normal column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabkit.functions.columns import cut, to_double
from tabkit.functions.normal import norm_ppf
from tabkit.plans.scalars import with_one_row


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.drop(df.columns[0])


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Listed (default: all) columns -> double; text that is no number -> NULL."""
    cols = set(cols) if cols is not None else set(df.columns)
    return df.select(*[to_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def cut_by_sd(df: DataFrame, col: str, k: float = 0.7,
              labels: Sequence[str] = ("Bajo", "Medio", "Alto"), out_col: str = "level") -> DataFrame:
    """Three bins with breaks ``min-1, mean-k*sd, mean+k*sd, max+1``
    (right-closed). The statistics are one aggregate row, broadcast."""
    stats = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"),
                   F.avg(col).alias("_m"), F.stddev_samp(col).alias("_sd"))
    j = with_one_row(df, stats)
    breaks = [F.col("_lo") - 1, F.col("_m") - k * F.col("_sd"),
              F.col("_m") + k * F.col("_sd"), F.col("_hi") + 1]
    return j.withColumn(out_col, cut(col, breaks, list(labels))).drop("_lo", "_hi", "_m", "_sd")


def with_random_normal(df: DataFrame, out_col: str = "rnorm", seed: int = 567, key: Sequence[str] | None = None) -> DataFrame:
    """A column of independent N(0, 1) draws, one per row (``rnorm(n)``:
    the draws do not depend on the data).

    With ``key``, the columns that identify a row, the draw is a function of
    key and seed (their hash as a uniform number, then the quantile): the
    same under any partitioning, retry or order, and equal for rows of equal
    key. Without, it is reproducible for a fixed seed and partitioning."""
    if key is None:
        return df.withColumn(out_col, F.randn(seed))
    return df.withColumn(out_col, uniform_at(key, seed)).withColumn(out_col, norm_ppf(out_col))


def uniform_at(key: Sequence[str], seed: int):
    """A number in (0, 1) from the first 52 bits of the hash of seed and key;
    a null part differs from any text."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in key]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))

"""Attach a one-row aggregate to every row without a join.

The aggregate becomes one scalar subquery (a struct of its columns): Spark
runs it once and inlines the value into the projection, so the plan holds
no cross or nested-loop join and nothing is broadcast but a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_one_row(df: DataFrame, one_row: DataFrame, name: str = "_one") -> DataFrame:
    """``df`` plus the columns of ``one_row`` (which must hold exactly one row)."""
    sc = one_row.select(F.struct(*[F.col(c) for c in one_row.columns])).scalar()
    return df.withColumn(name, sc).select(
        *[F.col(c) for c in df.columns],
        *[F.col(f"{name}.{c}").alias(c) for c in one_row.columns])

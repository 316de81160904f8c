"""Ranks in a sorted table, without a group ever in one task.

A table is range-partitioned in the wanted order and written with the number
of its part, so a lost task cannot move the bounds. Parts follow each other:
only groups that reach over a part's end need what stands in other parts,
and those are at most two in each part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabkit.scratch import Scratch


def in_order(df: DataFrame, order: Sequence[Column], s: Scratch, name: str) -> DataFrame:
    """``df`` written in parts (``_part``) that follow each other in ``order``;
    ``_tie`` numbers the rows, so that equal ones may lie in several parts."""
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    return s.table(numbered.repartitionByRange(*order, F.col("_tie").asc()).withColumn("_part", F.spark_partition_id()), name)


def rank_within(df: DataFrame, group: str, order: Sequence[Column], s: Scratch, name: str) -> DataFrame:
    """``df`` with ``rank`` (from 0) in its group, and ``total``, the group's
    rows. A null group is a group; equal rows rank in any order."""
    parts = in_order(df, [F.col(group).asc_nulls_first(), *order], s, name)
    counts = parts.groupBy("_part", group).agg(F.count("*").alias("n"))
    own = Window.partitionBy(group)
    # groups over several parts: two rows a part at most, so the broadcast is bounded by the number of parts
    split = (counts.withColumn("parts", F.count("*").over(own)).withColumn("_total", F.sum("n").over(own))
             .withColumn("_before", F.sum("n").over(own.orderBy("_part")) - F.col("n"))
             .where("parts > 1").select(F.col("_part").alias("_p"), F.col(group).alias("_g"), "_before", "_total"))
    placed = parts.join(F.broadcast(split), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")
    here = Window.partitionBy("_part", group)
    return placed.select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.row_number().over(here.orderBy(*order, "_tie")) - 1).cast("long").alias("rank"),
                         F.coalesce("_total", F.count("*").over(here)).cast("long").alias("total"))

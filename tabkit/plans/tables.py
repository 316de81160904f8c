"""Access to the driver-provided parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``defaultParallelism`` tasks when the scan
    yields fewer splits than that (small or unsplittable inputs, e.g. one
    parquet row group). Large inputs already have many splits and are
    returned unchanged, so no shuffle is added at scale. Filters and column
    pruning still reach the scan below the repartition."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Spark Connect session: leave the scan as is
        return df
    if current >= target:
        return df
    return df.repartition(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))

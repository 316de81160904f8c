"""Delimited and columnar file scans driven by a small source spec.

Schemas are explicit by default: inference costs a full extra pass over
the input and drifts types between runs (``'01'`` becomes ``1``). It stays
available as an opt-in for exploratory reads.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceSpec:
    format: str = "csv"              # csv | orc | parquet | text
    sep: str = ","
    header: bool = False
    schema: T.StructType | str | None = None
    infer_schema: bool = False
    options: dict = field(default_factory=dict)

    def reader(self, spark: SparkSession):
        r = spark.read.format(self.format)
        if self.format == "csv":
            r = r.option("sep", self.sep).option("header", str(self.header).lower())
            if self.schema is None and self.infer_schema:
                r = r.option("inferSchema", "true")
        if self.schema is not None:
            r = r.schema(self.schema)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r


def all_text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read(spark: SparkSession, paths: str | list[str], spec: SourceSpec) -> DataFrame:
    """One scan over one or many paths (a multi-path read replaces a chain
    of per-file ``unionAll``: one relation, one file listing)."""
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        return empty_table(spark, spec.schema)
    return spec.reader(spark).load(paths)


def read_pipe_with_header(spark: SparkSession, path, schema=None,
                          infer_schema: bool = False) -> DataFrame:
    """``|``-separated file with a header line (claims, catalogue)."""
    return read(spark, path, SourceSpec("csv", "|", True, schema, infer_schema))


def read_pipe_no_header(spark: SparkSession, path, schema) -> DataFrame:
    """``|``-separated header-less records with a fixed schema (rated calls)."""
    return read(spark, path, SourceSpec("csv", "|", False, schema))


def read_comma_no_header(spark: SparkSession, path, schema) -> DataFrame:
    """Comma-separated header-less records (outgoing fixed-line records)."""
    return read(spark, path, SourceSpec("csv", ",", False, schema))


def read_orc(spark: SparkSession, path, schema=None) -> DataFrame:
    return read(spark, path, SourceSpec("orc", schema=schema))


def empty_table(spark: SparkSession, schema) -> DataFrame:
    """Typed relation with no rows (result of an empty day list)."""
    if schema is None:
        schema = T.StructType([])
    if isinstance(schema, str):
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line (column ``value``), plus the source file name."""
    from pyspark.sql import functions as F
    return (spark.read.text(path)
            .select(F.col("value"), F.col("_metadata.file_name").alias("file_name")))

"""Day-window scans: every day from ``asof`` minus N months to ``asof``,
both ends included.

Two layouts are supported:

* **hive layout** ``<base>/<col>=YYYY-MM-DD/...`` (sub-directories such as
  ``delta*`` below the day are fine): one read of the base directory and a
  filter on the partition column; Catalyst turns it into
  ``PartitionFilters`` so only the window's directories are listed and read.
* **name-encoded layout** (day inside a file or directory name): the day
  globs are built, the ones that match nothing are skipped (and reported),
  and the rest are read in one multi-path scan.

``asof`` is always an argument: results must not depend on the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabkit.sources.delimited import SourceSpec, empty_table


def _as_date(asof) -> _dt.date:
    if isinstance(asof, _dt.datetime):
        return asof.date()
    if isinstance(asof, _dt.date):
        return asof
    return _dt.date.fromisoformat(str(asof))


def months_back(asof, months: int) -> _dt.date:
    """Calendar ``asof - months`` with the day clamped to the month's end."""
    d = _as_date(asof)
    m = d.month - 1 - months
    y = d.year + m // 12
    m = m % 12 + 1
    last = (_dt.date(y + (m == 12), m % 12 + 1, 1) - _dt.timedelta(days=1)).day
    return _dt.date(y, m, min(d.day, last))


def window_days(asof, months: int) -> list[_dt.date]:
    """All days of the window, oldest first (``|days| + 1`` of them)."""
    end = _as_date(asof)
    start = months_back(end, months)
    return [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]


def in_window(date_col: Column | str, asof, months: int) -> Column:
    """Predicate ``date_col`` within the window (date, timestamp or
    ``YYYY-MM-DD`` text column). On a partition column it prunes directories;
    on a parquet column it is pushed to the scan."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    end = F.lit(_as_date(asof))
    return F.to_date(c).between(F.add_months(end, -months), end)


def window_sequence(asof, months: int) -> Column:
    """The window's days as an ``array<date>`` column expression."""
    end = F.lit(_as_date(asof))
    return F.sequence(F.add_months(end, -months), end)


def read_hive_window(spark: SparkSession, base: str, spec: SourceSpec, partition_col: str,
                     asof, months: int) -> DataFrame:
    """Hive-layout window read. ``spec.schema`` should list the partition
    column (as string to keep ``YYYY-MM-DD`` text). Only the window's own day
    folders are listed and read, whatever the base holds besides."""
    lo = months_back(asof, months).isoformat()
    hi = _as_date(asof).isoformat()
    days = _partitions(spark, base, partition_col)
    inside = [d for d in days if lo <= d <= hi]
    if days and not inside:
        return empty_table(spark, spec.schema)
    try:
        if inside:
            df = spec.reader(spark).option("basePath", base).load([f"{base.rstrip('/')}/{partition_col}={d}" for d in inside])
        else:
            df = spec.reader(spark).load(base)
    except Exception as e:  # only a missing base directory is tolerated
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return empty_table(spark, spec.schema)
        raise
    return df.where(F.col(partition_col).between(lo, hi))


def _partitions(spark: SparkSession, base: str, partition_col: str) -> list[str]:
    """The values of the partition folders right below ``base`` (one listing)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(n[len(partition_col) + 1:] for n in names if n.startswith(f"{partition_col}="))


def _existing(spark: SparkSession, pattern: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    matches = path.getFileSystem(conf).globStatus(path)
    return matches is not None and len(matches) > 0


def read_named_days(spark: SparkSession, day_pattern, spec: SourceSpec, asof, months: int,
                    day_column: str | None = None, day_regex: str | None = None):
    """Name-encoded window read.

    ``day_pattern(date) -> glob``. Returns ``(df, skipped)`` where
    ``skipped`` is a DataFrame ``(day, path)`` of days whose glob matched no
    file; only "not found" is skipped, any other read error is raised.
    With ``day_column`` the day is recovered per row from the file path with
    ``day_regex`` (first group).
    """
    found, missing = [], []
    for d in window_days(asof, months):
        p = day_pattern(d)
        (found if _existing(spark, p) else missing).append((d, p))
    skipped = spark.createDataFrame(missing, "day date, path string")
    if not found:
        df = empty_table(spark, spec.schema)
        if day_column:
            df = df.withColumn(day_column, F.lit(None).cast("string"))
        return df, skipped
    df = spec.reader(spark).load([p for _, p in found])
    if day_column:
        df = df.withColumn(day_column,
                           F.regexp_extract(F.col("_metadata.file_path"), day_regex, 1))
    return df, skipped

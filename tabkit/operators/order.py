"""Order-dependent measures without a single-task global sort.

Everything here starts from a *frequency table* (one row per distinct value
and group, with its count) built by a partial-aggregating ``groupBy``; ties
are therefore resolved once and the ordered data is the distinct values,
not the rows.

``running_sum`` is the core: the table is range-partitioned on
``(keys, order)``, tagged with its partition id and checkpointed to the
shared checkpoint folder (so a recomputation after an executor loss cannot
move the range boundaries). Per-partition totals (at most P rows per group)
give each partition's offset, and the running sum itself is a window
*inside* each partition. No window ever runs without a partition key over
unbounded data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabkit.session import checkpoint_dir


def _list(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join on group keys with NULL-safe equality (a NULL group is a group).
    No keys -> the right side must be one row (cross join)."""
    keys = _list(keys)
    if not keys:
        from tabkit.plans.scalars import with_one_row
        return with_one_row(left, right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                 count_col: str = "n", drop_null: bool = False) -> DataFrame:
    """``(keys..., col, n)``: rows per distinct value (NULL is a value)."""
    keys = _list(keys)
    src = df.where(F.col(col).isNotNull()) if drop_null else df
    return src.groupBy(*keys, col).agg(F.count(F.lit(1)).alias(count_col))


def running_sum(df: DataFrame, value_col: str, order_cols: Sequence[str | Column],
                keys: Sequence[str] | None = None, out_col: str = "cum",
                partitions: int | None = None, nulls_last: bool = True) -> DataFrame:
    """Inclusive running sum of ``value_col`` in ``order_cols`` order within
    each group of ``keys`` (whole table when no keys).

    ``order_cols`` must make rows unique within a group (true for a
    frequency table). Adds ``out_col`` and ``_total`` (the group total).
    """
    keys = _list(keys)
    spark = df.sparkSession
    checkpoint_dir(spark)
    keyless = not keys
    if keyless:  # one group: a constant key keeps the code path the same
        df = df.withColumn("_g", F.lit(0))
        keys = ["_g"]
    order_exprs = []
    for c in _list(order_cols):
        col = F.col(c) if isinstance(c, str) else c
        order_exprs.append(col.asc_nulls_last() if nulls_last else col.asc_nulls_first())
    key_cols = [F.col(k).asc_nulls_last() for k in keys]
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_parts, *key_cols, *order_exprs)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    # At most P rows per group (P + groups rows in all): small.
    part_tot = ranged.groupBy("_pid", *keys).agg(F.sum(value_col).alias("_ptot"))
    w_off = Window.partitionBy(*keys).orderBy("_pid")
    offs = part_tot.select(
        "_pid", *keys,
        F.coalesce(F.sum("_ptot").over(w_off.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_ptot").over(Window.partitionBy(*keys)).alias("_total"))
    joined = join_on_keys(ranged, F.broadcast(offs) if keyless else offs, ["_pid", *keys], "inner")
    w_in = (Window.partitionBy("_pid", *keys).orderBy(*order_exprs)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = (joined.withColumn(out_col, F.col("_off") + F.sum(value_col).over(w_in))
           .drop("_pid", "_off", "_ptot"))
    return out.drop("_g") if keyless else out


def frequency_table(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                    partitions: int | None = None) -> DataFrame:
    """``(keys..., col, n, p, cum_p, cum_n)`` in ascending value order, NULL
    group kept and ordered last; ``p = 100 n / N``."""
    keys = _list(keys)
    vc = value_counts(df, col, keys)
    rs = running_sum(vc, "n", [col], keys, "cum_n", partitions)
    return rs.select(
        *keys, col, F.col("n").cast("bigint").alias("n"),
        (F.lit(100.0) * F.col("n") / F.col("_total")).alias("p"),
        (F.lit(100.0) * F.col("cum_n") / F.col("_total")).alias("cum_p"),
        F.col("cum_n").cast("bigint").alias("cum_n"),
        F.col("_total").cast("bigint").alias("total"),
    )


def share_of_total(df: DataFrame, value_col: str, out_col: str = "p",
                   keys: Sequence[str] | None = None) -> DataFrame:
    """``100 * v / sum(v)`` over the table or per group. The grand total is a
    one-row aggregate joined back by broadcast (one row: bounded)."""
    keys = _list(keys)
    tot = df.groupBy(*keys).agg(F.sum(value_col).alias("_sum"))
    j = join_on_keys(df, tot, keys)
    return j.withColumn(out_col, F.lit(100.0) * F.col(value_col) / F.col("_sum")).drop("_sum")


def ranked_values(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Distinct non-null values with ``n``, ``before`` (rows strictly below),
    ``cum_n``, ``total`` and the mid-rank ``before + (n + 1) / 2``."""
    return ranked_counts(value_counts(df, col, _list(keys), drop_null=True), col, keys, partitions)


def ranked_counts(counts: DataFrame, col: str, keys: Sequence[str] | None = None,
                  partitions: int | None = None) -> DataFrame:
    """``ranked_values`` of a table of ``(keys..., col, n)`` that is counted
    already (col is not null, one row a value and group)."""
    keys = _list(keys)
    rs = running_sum(counts, "n", [col], keys, "cum_n", partitions)
    return rs.select(*keys, col, "n", "cum_n", (F.col("cum_n") - F.col("n")).alias("before"),
                     F.col("_total").alias("total"),
                     ((F.col("cum_n") - F.col("n")) + (F.col("n") + 1) / 2.0).alias("mid_rank"))


def with_mid_rank(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                  out_col: str = "rank", partitions: int | None = None,
                  hot_rows: int = 1_000_000, salt_buckets: int = 64) -> DataFrame:
    """Rows of ``df`` with the tie-averaged rank of ``col`` (within ``keys``).

    The ranks table (one row per distinct value) is joined back by value.
    A value repeated on a large share of the rows would put all of them in
    one join task, so values with ``n >= hot_rows`` (known from the ranks
    table itself, no extra pass) are salted over ``salt_buckets`` tasks."""
    from tabkit.plans.skew import salted_join
    keys = _list(keys)
    r = ranked_values(df, col, keys, partitions)
    ranks = r.select(*keys, col, F.col("mid_rank").alias(out_col))
    hot = r.where(F.col("n") >= hot_rows).select(*keys, col)
    return salted_join(df, ranks, [*keys, col], "left", hot_rows, salt_buckets, hot=hot)


def order_positions(df: DataFrame, col: str, keys: Sequence[str] | None = None,
                    partitions: int | None = None, chunk: int = 1_000_000) -> DataFrame:
    """One row per non-null input row: ``(keys..., col, i, total)`` with
    ``i`` = 1..n its position in ascending order (ties take consecutive
    positions). Built from the ranked distinct values. A value repeated on
    many rows is first cut into position ranges of at most ``chunk`` and
    the ranges are spread over tasks before they are expanded, so no task
    generates more than ``chunk`` rows for one value."""
    keys = _list(keys)
    r = ranked_values(df, col, keys, partitions)
    first = F.col("before") + 1
    starts = F.sequence(first, F.col("cum_n"), F.lit(chunk).cast("long"))
    ranges = r.select(*keys, col, "total", "cum_n", F.explode(starts).alias("_s"))
    ranges = ranges.withColumn("_e", F.least(F.col("_s") + chunk - 1, F.col("cum_n")))
    ranges = ranges.repartition(*keys, col, "_s")   # ranges, not rows: small shuffle
    return ranges.select(*keys, col, "total",
                         F.explode(F.sequence(F.col("_s"), F.col("_e"))).alias("i"))

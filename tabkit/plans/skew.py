"""Skew-safe equi-join: split hot keys of the large side over salt buckets.

Hot keys are found by one pass over the large side with a mergeable summary
of its heavy hitters (``approx_top_k``: bounded memory in every task, one row
as result), or passed in when the caller already has the counts. The summary
follows ``TRACKED`` keys, so it finds every key that holds more than some
``4 / TRACKED`` of the rows; at most ``max_hot_keys`` of them are salted. Any
other choice of hot keys gives the same rows, so an estimate is enough. The
salt of a large-side row is a hash of the row and of the partition that holds
it: equal rows of different partitions get different salts, and a task
recomputed after an executor loss produces the same ones. Keys are compared
NULL-safe (a NULL group is a group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_SALT_BUCKETS = 64
MAX_HOT_KEYS = 10_000
TRACKED = 1 << 16


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _hash(like: DataFrame, keys: Sequence[str]):
    """A hash of the keys in the types of ``like``: the same for keys that are
    equal in a join, whatever their own types."""
    parts = []
    for k in keys:
        v = F.col(k).try_cast(like.schema[k].dataType)
        if like.schema[k].dataType.typeName() in ("double", "float"):
            v = F.when(F.isnan(v), F.lit(float("nan"))).when(v == 0, F.lit(0.0)).otherwise(v)
        parts.append(v)
    return F.xxhash64(*parts)


def hot_hashes(df: DataFrame, keys: str | Sequence[str], hot_rows: int, max_hot_keys: int = MAX_HOT_KEYS) -> list[int]:
    """Hashes of the keys with about ``hot_rows`` rows or more, at most
    ``max_hot_keys`` of them, by one pass over ``df``."""
    top = df.select(_hash(df, _keys(keys)).alias("h")).agg(F.expr(f"approx_top_k(h, {int(max_hot_keys)}, {TRACKED})").alias("top"))
    found = top.select(F.expr(f"transform(filter(top, t -> t.count >= {int(hot_rows)}), t -> t.item)")).first()[0]
    return sorted(found or [])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def salted_join(big: DataFrame, small: DataFrame, keys: str | Sequence[str], how: str = "inner",
                hot_rows: int = DEFAULT_HOT_ROWS,
                salt_buckets: int = DEFAULT_SALT_BUCKETS,
                max_hot_keys: int = MAX_HOT_KEYS,
                hot: DataFrame | None = None) -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` spread over
    ``salt_buckets`` tasks and the matching ``small`` rows replicated to each.

    ``how`` is ``inner`` or ``left`` (rows of ``big`` are preserved).
    """
    keys = _keys(keys)
    if hot is not None:
        hot = hot.select(*keys)
        n_hot = hot.limit(max_hot_keys + 1).count()
        if n_hot == 0:
            return _null_safe_join(big, small, keys, how)
    if hot is None or n_hot > max_hot_keys:
        hashes = hot_hashes(big, keys, hot_rows, max_hot_keys)
        if not hashes:                                   # no skew: plain join
            return _null_safe_join(big, small, keys, how)
        marked = [side.withColumn("_hot", _hash(big, keys).isin(hashes)) for side in (big, small)]
    else:
        hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))  # at most max_hot_keys keys
        marked = [_null_safe_join(side, hot, keys, "left") for side in (big, small)]
    row_hash = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in big.columns])
    big_s = (marked[0]
             .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row_hash, F.lit(salt_buckets)))
                         .otherwise(F.lit(0).cast("long")))
             .drop("_hot"))
    small_s = (marked[1]
               .withColumn("_salt", F.explode(
                   F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"),
                                                    F.lit(salt_buckets - 1).cast("long")))
                   .otherwise(F.array(F.lit(0).cast("long")))))
               .drop("_hot"))
    return _null_safe_join(big_s, small_s, [*keys, "_salt"], how).drop("_salt")

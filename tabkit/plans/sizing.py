"""Size-checked broadcast.

A side is broadcast only after one distributed aggregate (partial sums per
task, one row to the driver) shows that it holds at most ``max_rows`` rows and
``MAX_BYTES`` of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Default bound for dimension-like sides (claims files, catalogues).
DEFAULT_BROADCAST_ROWS = 2_000_000


# Bound on the values of a broadcast side, well below executor memory.
MAX_BYTES = 64 << 20


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = MAX_BYTES) -> bool:
    width = sum((F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)).cast("bigint") + 8
                 if t in ("string", "binary") else F.lit(16).cast("bigint") for n, t in df.dtypes),
                F.lit(0).cast("bigint"))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS):
    """Return ``(df_or_broadcast_df, is_broadcast)``."""
    if max_rows and max_rows > 0 and has_at_most(df, max_rows):
        return F.broadcast(df), True
    return df, False

"""Join-key normalisation shared by the claims operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def numeric_text_key(c: Column | str) -> Column:
    """Text key that compares like a number when it is one.

    ``'0051'`` and ``'51'`` give ``'51'``; text that is not an integer
    (``'*123#'``) is kept trimmed as is. NULL stays NULL. Never raises under
    ANSI mode (``try_cast``).
    """
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.coalesce(t.try_cast("bigint").cast("string"), t)

"""Column expressions for the scalar, string, array, date, binning and
recoding operators. Python-style indexing and slicing are expressed with
built-in functions so everything stays inside whole-stage codegen.

Where Python would raise (index out of range) the expressions return NULL;
ANSI-unsafe operations use the ``try_`` forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# ---- arithmetic -------------------------------------------------------------

def true_div(a, b) -> Column:
    """``a / b`` as double; NULL for a zero divisor instead of an error."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def py_mod(a, b) -> Column:
    """Modulo with the sign of the divisor (Python ``%``); NULL for a zero divisor."""
    a, b = _c(a), F.nullif(_c(b), F.lit(0))
    return F.when(b < 0, -F.pmod(-a, -b)).otherwise(F.pmod(a, b))


def int_power(a, b) -> Column:
    """Integer power (``a ** b`` for integral inputs), as bigint."""
    return F.power(_c(a), _c(b)).cast("bigint")


def round_half_even(x, scale: int = 0) -> Column:
    """R's ``round``: half to even."""
    return F.bround(_c(x), scale)


def ratio_log10_sq(a, b) -> Column:
    """``log10(a / b) ^ 2``; NULL for a zero divisor or non-positive ratio."""
    r = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.pow(F.log10(F.when(r > 0, r)), 2)


def ratio_sqrt(a, b) -> Column:
    r = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.sqrt(F.when(r >= 0, r))


def to_double(x) -> Column:
    """Text -> double; unparsable text gives NULL (``as.numeric``)."""
    return _c(x).cast("string").try_cast("double")


# ---- Python-style indexing / slicing on strings and arrays ----------------

def _norm_bound(i, n: Column, default: Column) -> Column:
    """Python slice bound -> 0-based offset clipped to [0, n]."""
    if i is None:
        return default
    i = _c(i)
    return F.least(F.greatest(F.when(i < 0, n + i).otherwise(i), F.lit(0)), n)


def char_at(s, i) -> Column:
    """``s[i]`` (0-based, negative from the end); NULL out of range."""
    s, i = _c(s), _c(i)
    n = F.length(s)
    pos = F.when(i < 0, n + i).otherwise(i)
    return F.when((pos >= 0) & (pos < n), F.substring(s, pos + 1, 1))


def str_slice(s, start=None, stop=None) -> Column:
    """``s[start:stop]`` with Python clipping rules (step 1)."""
    s = _c(s)
    n = F.length(s)
    a = _norm_bound(start, n, F.lit(0))
    b = _norm_bound(stop, n, n)
    return F.when(s.isNotNull(), F.substring(s, a + 1, F.greatest(b - a, F.lit(0))))


def replace_first_char(s, new: str) -> Column:
    """``new + s[1:]``."""
    return F.concat(F.lit(new), str_slice(s, 1, None))


def arr_get(a, i) -> Column:
    """``a[i]`` (0-based, negative from the end); NULL out of range."""
    a, i = _c(a), _c(i)
    n = F.size(a)
    pos = F.when(i < 0, n + i).otherwise(i)
    return F.when((pos >= 0) & (pos < n), F.get(a, pos))


def arr_slice(a, start=None, stop=None) -> Column:
    """``a[start:stop]`` with Python clipping rules; empty array when empty."""
    a = _c(a)
    n = F.size(a)
    lo = _norm_bound(start, n, F.lit(0))
    hi = _norm_bound(stop, n, n)
    return F.filter(a, lambda x, j: (j >= lo) & (j < hi))


def arr_set(a, i, value) -> Column:
    """``a[i] = value`` (returns the new array; out of range leaves it)."""
    a = _c(a)
    n = F.size(a)
    i = _c(i)
    pos = F.when(i < 0, n + i).otherwise(i)
    return F.transform(a, lambda x, j: F.when(j == pos, _c(value)).otherwise(x))


def arr_replace_slice(a, start, stop, new) -> Column:
    """``a[start:stop] = new`` (``new`` empty deletes the slice)."""
    return F.concat(arr_slice(a, None, start), _c(new), arr_slice(a, stop, None))


def arr_append(a, value) -> Column:
    return F.array_append(_c(a), _c(value))


# ---- durations ------------------------------------------------------------

def seconds_to_hms(x) -> Column:
    """Whole seconds -> the text Python gives for
    ``str(timedelta(seconds=x)).zfill(8)``: ``HH:MM:SS`` under one day,
    ``'1 day, 1:01:01'`` / ``'2 days, 0:00:05'`` from one day on."""
    s = _c(x).cast("bigint")
    days = F.floor(s / 86400).cast("bigint")
    rem = s - days * 86400
    h = F.floor(rem / 3600).cast("bigint")
    m = F.floor((rem % 3600) / 60).cast("bigint")
    sec = rem % 60
    mmss = F.concat(F.lit(":"), F.lpad(m.cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(sec.cast("string"), 2, "0"))
    same_day = F.lpad(F.concat(h.cast("string"), mmss), 8, "0")
    with_days = F.concat(days.cast("string"),
                         F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")),
                         h.cast("string"), mmss)
    return F.when(s.isNull(), F.lit(None).cast("string")) \
        .when(days == 0, same_day).otherwise(with_days)


# ---- binning / recoding ---------------------------------------------------

def cut(x, breaks: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed intervals ``(b[i], b[i+1]]``; outside (or NULL) -> NULL.

    Returns the label, or the 1-based interval number when ``labels`` is None.
    """
    x = _c(x)
    if labels is not None and len(labels) != len(breaks) - 1:
        raise ValueError("need len(breaks) - 1 labels")
    expr = None
    for i in range(len(breaks) - 1):
        lo, hi = breaks[i], breaks[i + 1]
        out = F.lit(labels[i]) if labels is not None else F.lit(i + 1)
        cond = (x > _c(lo)) & (x <= _c(hi))
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr


def cut_level(x, breaks: Sequence[float]) -> Column:
    """1-based interval number of ``cut`` (NULL outside)."""
    return cut(x, breaks, None)


def recode(x, mapping: dict, default=0.0) -> Column:
    """Look ``x`` up in a literal map; unmatched and NULL -> ``default``."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), _c(x)), F.lit(default))


# Fixed values of the fuel exercise (slope text -> fraction, else 0).
SLOPE_RECODE = {"+10%": 0.1, "+6%": 0.06, "-10%": -0.1, "-6%": -0.06}

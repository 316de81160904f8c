"""Tail probabilities of the t, chi-squared and F distributions as column
expressions: everything stays in the JVM, no Python worker takes part.

The regularised incomplete beta function is its continued fraction and the
incomplete gamma function its series or continued fraction (modified Lentz),
run as an ``aggregate`` over a bounded sequence with a convergence flag; an
expansion that has not converged at the end of its sequence raises. Beyond
``LARGE`` a parameter takes its limit: the beta tail becomes a gamma tail with
the first-order correction in the scale (relative error of the order of
``1 / LARGE``), two large ones Paulson's normal form, a gamma shape Wilson and
Hilferty's.

Meant for one row per test. NULL in gives NULL; degrees of freedom that are
not positive give NaN.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, functions as F

from tabkit.functions.normal import norm_cdf, norm_ppf

LARGE = 1e8
# Spearman: exact distribution to so many rows, series below so many, t beyond.
RANK_EXACT = 9
RANK_SERIES = 1290
_EPS = 1e-15
_TINY = 1e-300
_NAN = float("nan")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _lets(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    return _let(F.struct(*(v.cast("double").alias(k) for k, v in values.items())), body)


def _away_from_zero(v: Column) -> Column:
    return F.when(F.abs(v) > _TINY, v).otherwise(F.lit(_TINY))


def _converge(steps: Column, start: dict[str, Column], step: Callable[[Column, Column], Column], what: str) -> Column:
    """The ``h`` of a loop over structs with ``h`` and ``done``."""
    first = F.struct(*(v.cast("double").alias(k) for k, v in start.items()), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(1).cast("long"), F.ceil(steps).cast("long")), first, lambda s, m: F.when(s["done"], s).otherwise(step(s, m.cast("double"))))
    return _let(end, lambda s: F.when(s["done"], s["h"]).otherwise(F.raise_error(F.lit(f"{what} did not converge")).cast("double")))


def _lentz(a_n: Column, b_n: Column, s: Column) -> Column:
    """(c, d, delta) after one term of a continued fraction."""
    d = 1.0 / _away_from_zero(b_n + a_n * s["d"])
    c = _away_from_zero(b_n + a_n / s["c"])
    return F.struct(c.alias("c"), d.alias("d"), (c * d).alias("delta"))


def _stirling(w: Column) -> Column:
    u = 1.0 / (w * w)
    # The series' coefficients.
    return (w - 0.5) * F.ln(w) - w + 0.9189385332046727 + (1 / 12 - u * (1 / 360 - u * (1 / 1260 - u * (1 / 1680 - u / 1188)))) / w


def ln_gamma(z: Column) -> Column:
    """ln of the gamma function, z > 0: Stirling's series, below 15 at 15 more
    than z and divided by the factors between."""
    def of(v: Column) -> Column:
        between = F.aggregate(F.sequence(F.lit(0), F.lit(14)), F.lit(1.0), lambda p, k: p * (v["z"] + k))
        return _stirling(v["w"]) - F.when(v["z"] < 15, F.ln(between)).otherwise(0.0)

    z = z.cast("double")
    return _lets({"z": z, "w": F.when(z < 15, z + 15.0).otherwise(z)}, of)


def ln_beta(a: Column, b: Column) -> Column:
    """ln B(a, b); for a large parameter by the difference of Stirling's
    series, which does not cancel as a difference of logarithms does."""
    def of(s: Column) -> Column:
        a, b = s["a"], s["b"]

        def far(g: Column) -> Column:
            rest = F.transform(F.array(a, a + b), lambda z: 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z))
            return g[1] - (a - 0.5) * F.log1p(b / a) - b * F.ln(a + b) + b + _let(rest, lambda r: r[0] - r[1])

        return _let(F.transform(F.array(a, b, a + b), ln_gamma), lambda g: F.when(a < 100, g[0] + g[1] - g[2]).otherwise(far(g)))

    return _lets({"a": F.greatest(a, b), "b": F.least(a, b)}, of)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    def step(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a - 1.0 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1.0 + 2 * m))
        one = F.lit(1.0)
        return _let(_lentz(even, one, s), lambda e: _let(_lentz(odd, one, e), lambda o: F.struct(
            o["c"].alias("c"), o["d"].alias("d"), (s["h"] * e["delta"] * o["delta"]).alias("h"), (F.abs(o["delta"] - 1.0) < _EPS).alias("done"))))

    d = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    return _converge(200 + 12 * F.sqrt(F.greatest(a, b)), {"c": F.lit(1.0), "d": d, "h": d}, step, "incomplete beta")


def gamma_upper(shape: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma Q(shape, x)."""
    def of(v: Column) -> Column:
        s, x = v["s"], v["x"]
        front = F.exp(-x + s * F.ln(x) - ln_gamma(s))

        def term(p: Column, k: Column) -> Column:
            return _let(p["delta"] * x / (s + k), lambda delta: F.struct(
                delta.alias("delta"), (p["h"] + delta).alias("h"), (delta < (p["h"] + delta) * _EPS).alias("done")))

        def fraction(p: Column, i: Column) -> Column:
            return _let(_lentz(-i * (i - s), x + 1.0 - s + 2 * i, p), lambda e: F.struct(
                e["c"].alias("c"), e["d"].alias("d"), (p["h"] * e["delta"]).alias("h"), (F.abs(e["delta"] - 1.0) < _EPS).alias("done")))

        steps = 400 + 12 * F.sqrt(s)
        series = _converge(steps, {"delta": 1.0 / s, "h": 1.0 / s}, term, "incomplete gamma")
        d = 1.0 / _away_from_zero(x + 1.0 - s)
        tail = _converge(steps, {"c": F.lit(1 / _TINY), "d": d, "h": d}, fraction, "incomplete gamma")
        normal = norm_cdf(-((F.pow(x / s, 1 / 3) - 1 + 1 / (9 * s)) * 3 * F.sqrt(s)))
        return (F.when(x <= 0, F.lit(1.0)).when(s > LARGE, normal)
                .when(x < s + 1, F.greatest(F.lit(0.0), 1.0 - series * front)).otherwise(front * tail))

    return _lets({"s": shape, "x": x}, of)


def beta_upper(a: Column, b: Column, r: Column) -> Column:
    """I_x(a, b) at ``x = 1 / (1 + r)``: the upper tail of the ratio r of two
    gamma variables of shapes b and a. ``r`` is kept apart from 1, so that a
    small ratio is not lost in ``1 - x``."""
    def of(v: Column) -> Column:
        a, b, r, x = v["a"], v["b"], v["r"], 1.0 / (1.0 + v["r"])
        f, g = F.pow(r * a / b, 1 / 3), F.pow(r * a / b, 2 / 3)
        paulson = norm_cdf(-(((1 - 1 / (9 * a)) * f - (1 - 1 / (9 * b))) / F.sqrt(g / (9 * a) + 1 / (9 * b))))
        # one of the two tails is taken, and turned round where it is the other one
        near = x < (a + 1) / (a + b + 2)
        fraction = _lets({"a": F.when(near, a).otherwise(b), "b": F.when(near, b).otherwise(a), "x": F.when(near, x).otherwise(r * x)}, lambda s: (
            F.exp(-a * F.log1p(r) + b * (F.ln(r) - F.log1p(r)) - ln_beta(a, b)) * _beta_fraction(s["a"], s["b"], s["x"]) / s["a"]))
        limit = gamma_upper(F.when(a > LARGE, b).otherwise(a), F.when(a > LARGE, F.log1p(r) * (a + (b - 1) / 2)).otherwise(F.log1p(1.0 / r) * (b + (a - 1) / 2)))
        tail = F.when(F.greatest(a, b) > LARGE, limit).otherwise(fraction)
        turned = F.when(a > LARGE, F.lit(False)).when(b > LARGE, F.lit(True)).otherwise(~near)
        return (F.when(r <= 0, F.lit(1.0)).when((F.greatest(a, b) > LARGE) & (F.least(a, b) > 1e4), paulson)
                .otherwise(_let(tail, lambda t: F.when(turned, 1.0 - t).otherwise(t))))

    return _lets({"a": a, "b": b, "r": r}, of)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| >= |t|), T ~ Student t(df)."""
    ok = t.isNotNull() & df.isNotNull()
    tail = F.when(F.isnan(t) | F.isnan(df) | (df <= 0), F.lit(_NAN)).when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(beta_upper(df / 2, F.lit(0.5), t * t / df))
    return F.when(ok, tail)


def chi2_upper(x: Column, df: Column) -> Column:
    tail = F.when(F.isnan(x) | (df <= 0), F.lit(_NAN)).otherwise(gamma_upper(df / 2, x / 2))
    return F.when(x.isNotNull() & df.isNotNull(), tail)


def f_upper(f: Column, d1: Column, d2: Column) -> Column:
    tail = (F.when(F.isnan(f) | (d1 <= 0) | (d2 <= 0), F.lit(_NAN)).when(f <= 0, F.lit(1.0)).when(f == float("inf"), F.lit(0.0))
            .otherwise(beta_upper(d2 / 2, d1 / 2, d1 * f / d2)))
    return F.when(f.isNotNull() & d1.isNotNull() & d2.isNotNull(), tail)


def t_quantile(p: Column, df: Column) -> Column:
    """Quantile of Student t, by Newton's method from the normal quantile:
    beyond the median the distribution function is concave, so the steps
    rise to the quantile and never pass it."""
    def of(v: Column) -> Column:
        p, df = v["p"], v["df"]
        mass = 2 * F.least(p, 1 - p)
        ln_top = -ln_beta(df / 2, F.lit(0.5)) - F.ln(df) / 2

        def step(s: Column, _: Column) -> Column:
            x = s["h"]
            density = F.exp(ln_top - (df + 1) / 2 * F.log1p(x * x / df))
            return _let((t_two_sided(x, df) - mass) / (2 * density), lambda move: F.struct((x + move).alias("h"), (move <= x * 1e-14).alias("done")))

        size = _converge(F.lit(200), {"h": norm_ppf(1 - mass / 2)}, step, "t quantile")
        return F.when(p == 0.5, F.lit(0.0)).when(p > 0.5, size).otherwise(-size)

    return F.when((p > 0) & (p < 1) & (df > 0), _lets({"p": p, "df": df}, of))


def lilliefors_p(d: Column, n: Column) -> Column:
    """Lilliefors p-value: Dallal & Wilkinson (1986) below 0.1, Stephens'
    (1974) modified statistic above; NaN for fewer than five values."""
    def of(v: Column) -> Column:
        d, n = v["d"], v["n"]
        kd, nd = F.when(n <= 100, d).otherwise(d * F.pow(n / 100, 0.49)), F.least(n, F.lit(100.0))
        # Published coefficients.
        small = F.exp(-7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * F.sqrt(nd + 2.78019) - 0.122119 + 0.974598 / F.sqrt(nd) + 1.67997 / nd)
        k = (F.sqrt(n) - 0.01 + 0.85 / F.sqrt(n)) * d
        large = (F.when(k <= 0.302, F.lit(1.0))
                 .when(k <= 0.5, 2.76773 - 19.828315 * k + 80.709644 * k * k - 138.55152 * k * k * k + 81.218052 * k * k * k * k)
                 .when(k <= 0.9, -4.901232 + 40.662806 * k - 97.490286 * k * k + 94.029866 * k * k * k - 32.355711 * k * k * k * k)
                 .when(k <= 1.31, 6.198765 - 19.55803 * k + 23.186922 * k * k - 17.034965 * k * k * k + 4.79535 * k * k * k * k)
                 .otherwise(F.lit(0.0)))
        return F.when((n < 5) | F.isnan(d), F.lit(_NAN)).when(small > 0.1, large).otherwise(small)

    return F.when(d.isNotNull() & n.isNotNull(), _lets({"d": d, "n": n}, of))


@lru_cache
def rank_distance_counts(n: int) -> tuple[int, ...]:
    """How many permutations of 1..n have the sum of squared rank differences
    0, 2, 4, ...: positions are filled in turn, over the sets of ranks used."""
    half = (n ** 3 - n) // 6
    ways = {0: {0: 1}}
    for place in range(n):
        filled: dict[int, dict[int, int]] = {}
        for used, sums in ways.items():
            for rank in range(n):
                if not used >> rank & 1:
                    into = filled.setdefault(used | 1 << rank, {})
                    for total, k in sums.items():
                        total += (place - rank) ** 2
                        into[total] = into.get(total, 0) + k
        ways = filled
    return tuple(ways[(1 << n) - 1].get(2 * i, 0) for i in range(half + 1))


def _rank_two_sided(n: int) -> list[float]:
    """Two-sided p for the sums 0, 2, 4, ... of n ranks without ties."""
    counts = rank_distance_counts(n)
    total, centre = sum(counts), (n ** 3 - n) / 6
    low = [sum(counts[:i + 1]) for i in range(len(counts))]
    return [min(1.0, 2 * (low[i] if 2 * i <= centre else total - low[i] + c) / total) for i, c in enumerate(counts)]


# Best and Roberts (1975), Algorithm AS 89, c1 to c12.
_AS89 = [0.2274, 0.2531, 0.1745, 0.0758, 0.1033, 0.3932, 0.0879, 0.0151, 0.0072, 0.0831, 0.0131, 4.6e-4]


def spearman_two_sided(s: Column, n: Column) -> Column:
    """Two-sided p of the sum ``s`` of squared rank differences of ``n`` rows
    without ties: the exact distribution to ``RANK_EXACT`` rows, beyond it the
    Edgeworth series of AS 89. NULL under two rows."""
    table = "array(" + ", ".join(f"array({', '.join(f'{p!r}D' for p in _rank_two_sided(k))})" for k in range(2, RANK_EXACT + 1)) + ")"
    even = F.round(s / 2)
    exact = F.get(F.get(F.expr(table), (n - 2).cast("int")), even.cast("int"))
    c = _AS89

    def series(v: Column) -> Column:
        n, at = v["n"], v["at"]
        b = 1 / n
        x = (6 * (at - 1) * b / (n * n - 1) - 1) * F.sqrt(n - 1)

        def upper(x: Column) -> Column:
            y = x * x
            inner = c[8] - c[9] * b + y * b * (c[10] - c[11] * y)
            u = x * b * (c[0] + b * (c[1] + c[2] * b) + y * (-c[3] + b * (c[4] + c[5] * b) - y * b * (c[6] + c[7] * b - y * inner)))
            p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), u / F.exp(y / 2) + norm_cdf(-x)))
            return F.least(F.lit(1.0), 2 * F.when(v["high"] == 1, p).otherwise(1 - p))

        return _let(x, upper)

    # P(S >= s) above the centre, P(S <= s) = 1 - P(S >= s + 2) elsewhere
    high = 2 * even > (n * n * n - n) / 6
    edge = _lets({"n": n, "at": F.when(high, 2 * even).otherwise(2 * even + 2), "high": high.cast("int")}, series)
    return F.when(n < 2, F.lit(None).cast("double")).when(n <= RANK_EXACT, exact).otherwise(edge)

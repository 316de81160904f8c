"""Distribution functions for single numbers on the driver (no SciPy needed):
the scalar forms of the column expressions in ``tails.py``.

Regularised incomplete beta by its continued fraction (modified Lentz),
regularised incomplete gamma by series / continued fraction. An expansion
that does not converge raises. Where one shape parameter is beyond
``_LARGE`` the beta tail is its gamma limit with the first-order correction
in the scale (relative error of the order of ``1 / _LARGE``), and a gamma
shape beyond it takes the Wilson-Hilferty normal limit.
"""

from __future__ import annotations

import math

_EPS = 1e-15
_TINY = 1e-300
_LARGE = 1e8
_STEPS = 100_000


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, _STEPS):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            return h
    raise ArithmeticError(f"incomplete beta ({a}, {b}, {x}) did not converge")


def _log_beta(a: float, b: float) -> float:
    """ln B(a, b); for a large parameter by the difference of Stirling's
    series, which does not cancel as ``lgamma`` differences do."""
    a, b = max(a, b), min(a, b)
    if a < 100.0:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)

    def rest(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)

    ratio = (a - 0.5) * -math.log1p(b / a) - b * math.log(a + b) + b + rest(a) - rest(a + b)
    return math.lgamma(b) + ratio


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = a * math.log(x) + b * math.log1p(-x) - _log_beta(a, b)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def gammainc_upper(s: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(s, x)."""
    if x <= 0.0:
        return 1.0
    if s > _LARGE:
        z = ((x / s) ** (1 / 3) - 1 + 1 / (9 * s)) * 3 * math.sqrt(s)
        return 0.5 * math.erfc(z / math.sqrt(2))
    gln = math.lgamma(s)
    if x < s + 1.0:
        ap, total, delta = s, 1.0 / s, 1.0 / s
        for _ in range(_STEPS):
            ap += 1.0
            delta *= x / ap
            total += delta
            if abs(delta) < abs(total) * _EPS:
                return max(0.0, 1.0 - total * math.exp(-x + s * math.log(x) - gln))
        raise ArithmeticError(f"incomplete gamma ({s}, {x}) did not converge")
    b = x + 1.0 - s
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _STEPS):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            return math.exp(-x + s * math.log(x) - gln) * h
    raise ArithmeticError(f"incomplete gamma ({s}, {x}) did not converge")


def _upper_beta(a: float, b: float, r: float) -> float:
    """I_x(a, b) at ``x = 1 / (1 + r)``: the upper tail of the ratio r of two
    gamma variables of shapes b and a. ``r`` is kept apart from 1, so that a
    small ratio is not lost in ``1 - x``."""
    if r <= 0.0:
        return 1.0
    if max(a, b) > _LARGE and min(a, b) > 1e4:      # Paulson's normal limit
        f, u, v = r * a / b, 1 / (9 * b), 1 / (9 * a)
        z = ((1 - v) * f ** (1 / 3) - (1 - u)) / math.sqrt(v * f ** (2 / 3) + u)
        return 0.5 * math.erfc(z / math.sqrt(2))
    if a > _LARGE:
        # ln(1 + r) (a + (b - 1) / 2) is gamma(b) but for terms in 1 / a ** 2
        return gammainc_upper(b, math.log1p(r) * (a + (b - 1) / 2))
    if b > _LARGE:
        return 1.0 - gammainc_upper(a, math.log1p(1 / r) * (b + (a - 1) / 2))
    x, y = 1 / (1 + r), r / (1 + r)
    front = math.exp(-a * math.log1p(r) + b * (math.log(r) - math.log1p(r)) - _log_beta(a, b))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, y) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value P(|T| >= |t|), T ~ Student t(df)."""
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return _upper_beta(df / 2.0, 0.5, t * t / df)


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or math.isnan(x) or df <= 0:
        return float("nan")
    return gammainc_upper(df / 2.0, x / 2.0)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    return _upper_beta(d2 / 2.0, d1 / 2.0, d1 * f / d2)


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student t by bisection on the CDF (for intervals)."""
    if not 0 < p < 1:
        return float("nan")
    if p == 0.5:
        return 0.0
    target = 2 * min(p, 1 - p)       # two-sided tail mass
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) > target:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    x = (lo + hi) / 2
    return x if p > 0.5 else -x


def lilliefors_p(d: float, n: int) -> float:
    """Lilliefors p-value: Dallal & Wilkinson (1986) below 0.1, Stephens'
    (1974) modified statistic above (the form used by R's nortest)."""
    if d is None or n is None or n < 5 or math.isnan(d):
        return float("nan")
    if n <= 100:
        kd, nd = d, n
    else:
        kd, nd = d * (n / 100) ** 0.49, 100
    # Published coefficients.
    p = math.exp(-7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * math.sqrt(nd + 2.78019)
                 - 0.122119 + 0.974598 / math.sqrt(nd) + 1.67997 / nd)
    if p > 0.1:
        kk = (math.sqrt(n) - 0.01 + 0.85 / math.sqrt(n)) * d
        if kk <= 0.302:
            p = 1.0
        elif kk <= 0.5:
            p = 2.76773 - 19.828315 * kk + 80.709644 * kk ** 2 - 138.55152 * kk ** 3 + 81.218052 * kk ** 4
        elif kk <= 0.9:
            p = -4.901232 + 40.662806 * kk - 97.490286 * kk ** 2 + 94.029866 * kk ** 3 - 32.355711 * kk ** 4
        elif kk <= 1.31:
            p = 6.198765 - 19.55803 * kk + 23.186922 * kk ** 2 - 17.034965 * kk ** 3 + 4.79535 * kk ** 4
        else:
            p = 0.0
    return p

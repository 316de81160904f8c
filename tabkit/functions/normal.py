"""Standard normal CDF and quantile as Spark column expressions (JVM-side,
vectorised; Spark has neither ``erf`` nor ``qnorm``).

* ``norm_cdf``: Hart's double-precision rational approximation as given by
  G. West (2005), "Better approximations to cumulative normal functions".
* ``norm_ppf``: Wichura (1988), Algorithm AS 241 (PPND16), the same
  coefficients as Python's ``statistics.NormalDist.inv_cdf``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _poly(x: Column, coefs) -> Column:
    """Horner evaluation, coefficients from the highest degree down."""
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


# Hart (1968) / West (2005) coefficients.
_HART_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
             112.079291497871, 221.213596169931, 220.206867912376]
_HART_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
             296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]


def norm_cdf(z) -> Column:
    """P(Z <= z) for a standard normal Z."""
    z = F.col(z) if isinstance(z, str) else z
    a = F.abs(z)
    e = F.exp(-a * a / 2)
    near = e * _poly(a, _HART_NUM) / _poly(a, _HART_DEN)
    b = a + 0.65
    b = a + 4 / b
    b = a + 3 / b
    b = a + 2 / b
    b = a + 1 / b
    far = e / b / 2.506628274631
    tail = F.when(a > 37, F.lit(0.0)).when(a < 7.07106781186547, near).otherwise(far)
    return F.when(z.isNull(), F.lit(None).cast("double")).when(z > 0, 1 - tail).otherwise(tail)


# Wichura (1988) AS 241 coefficients, highest degree first.
_A = [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853,
      45921.953931549871457, 13731.693765509461125, 1971.5909503065514427,
      133.14166789178437745, 3.387132872796366608]
_B = [5226.495278852545561, 28729.085735721942674, 39307.89580009271061,
      21213.794301586595867, 5394.1960214247511077, 687.1870074920579083,
      42.313330701600911252, 1.0]
_C = [0.00077454501427834140764, 0.0227238449892691845833, 0.24178072517745061177,
      1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055,
      4.6303378461565452959, 1.42343711074968357734]
_D = [1.05075007164441684324e-9, 0.0005475938084995344946, 0.0151986665636164571966,
      0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494,
      2.05319162663775882187, 1.0]
_E = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386,
      0.026532189526576123093, 0.29656057182850489123, 1.7848265399172913358,
      5.4637849111641143699, 6.6579046435011037772]
_F = [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5,
      0.0007868691311456132591, 0.0148753612908506148525, 0.13692988092273580531,
      0.59983220655588793769, 1.0]


def norm_ppf(p) -> Column:
    """Standard normal quantile; NULL outside (0, 1)."""
    p = F.col(p) if isinstance(p, str) else p
    q = p - 0.5
    r1 = F.lit(0.180625) - q * q
    central = q * _poly(r1, _A) / _poly(r1, _B)
    r = F.sqrt(-F.ln(F.when(q <= 0, p).otherwise(1 - p)))
    mid = _poly(r - 1.6, _C) / _poly(r - 1.6, _D)
    far = _poly(r - 5.0, _E) / _poly(r - 5.0, _F)
    tail = F.when(r <= 5.0, mid).otherwise(far)
    tail = F.when(q < 0, -tail).otherwise(tail)
    return (F.when((p <= 0) | (p >= 1) | p.isNull(), F.lit(None).cast("double"))
            .when(F.abs(q) <= 0.425, central).otherwise(tail))


def norm_ppf_sql(p: str) -> str:
    """``norm_ppf`` as an SQL expression of the expression ``p`` in (0, 1)."""
    def poly(x, coefs):
        acc = f"{coefs[0]!r}::DOUBLE"
        for c in coefs[1:]:
            acc = f"({acc} * {x} + {c!r}::DOUBLE)"
        return acc

    r1 = f"(0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5))"
    r = f"sqrt(-ln(CASE WHEN {p} <= 0.5 THEN {p} ELSE 1 - {p} END))"
    mid = f"{poly(f'({r} - 1.6)', _C)} / {poly(f'({r} - 1.6)', _D)}"
    far = f"{poly(f'({r} - 5.0)', _E)} / {poly(f'({r} - 5.0)', _F)}"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {poly(r1, _A)} / {poly(r1, _B)} "
            f"ELSE (CASE WHEN {p} < 0.5 THEN -1 ELSE 1 END) * (CASE WHEN {r} <= 5.0 THEN {mid} ELSE {far} END) END")

"""Hypothesis tests bound to the driver tables: ``*_stat`` queries carry the
statistics, ``*_test`` queries add p-values. The SQL twins of the p-values
sum the continued fractions and series in recursive queries."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tabkit.functions import normal
from tabkit.operators import describe as D
from tabkit.operators import inference as H
from tabkit.plans.bind_describe import rounded
from tabkit.plans.tables import table


def _li(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def q_pearson_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.pearson_stats(_li(spark, sf_dir), "l_quantity", "l_extendedprice"), 6)


SQL_PEARSON = """
WITH g AS (SELECT count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem)
SELECT CAST(n AS BIGINT) AS n, round(r, 6) AS estimate, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS statistic,
       CAST(n - 2 AS BIGINT) AS df,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high
FROM g"""


def q_pearson_by_flag_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.pearson_stats(_li(spark, sf_dir), "l_quantity", "l_extendedprice", ["l_returnflag"]), 6)


SQL_PEARSON_BY_FLAG = """
WITH g AS (SELECT l_returnflag, count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(n AS BIGINT) AS n, round(r, 6) AS estimate,
       round(r * sqrt((n - 2) / (1 - r * r)), 6) AS statistic, CAST(n - 2 AS BIGINT) AS df,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high
FROM g"""


def q_spearman_stat(spark: SparkSession, sf_dir: str):
    s = H.spearman_stats(_li(spark, sf_dir), "l_quantity", "l_extendedprice")
    # S grows like n^3: compare it relative to its maximum (n^3 - n) / 3 so the
    # rounded value stays within double precision at every scale factor
    n = F.col("n").cast("double")
    return rounded(s.select("n", "estimate", (F.col("statistic") / ((n * n * n - n) / 3)).alias("statistic_rel"),
                            "df"), 6)


SQL_SPEARMAN = """
WITH r AS (
  SELECT (rank() OVER (ORDER BY l_quantity) + rank() OVER (ORDER BY l_quantity)
          + count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
         (rank() OVER (ORDER BY l_extendedprice) + rank() OVER (ORDER BY l_extendedprice)
          + count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb
  FROM lineitem),
g AS (SELECT count(*) AS n, corr(ra, rb) AS rho FROM r)
SELECT CAST(n AS BIGINT) AS n, round(rho, 6) AS estimate,
       round(((CAST(n AS DOUBLE) * n * n - n) * (1 - rho) / 6) / ((CAST(n AS DOUBLE) * n * n - n) / 3), 6) AS statistic_rel,
       CAST(n - 2 AS BIGINT) AS df FROM g"""


def _flag_counts(spark, sf_dir):
    return D.contingency(_li(spark, sf_dir), "l_returnflag", "l_linestatus", ["A", "N", "R"], ["F", "O"])


def _returned_counts(spark, sf_dir):
    li = _li(spark, sf_dir).withColumn("returned", F.when(F.col("l_returnflag") == "R", "yes").otherwise("no"))
    return D.contingency(li, "returned", "l_linestatus", ["no", "yes"], ["F", "O"])


def q_chisq_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.chisq_stats(_flag_counts(spark, sf_dir), "l_returnflag", "l_linestatus"), 6)


def q_chisq_yates_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.chisq_stats(_returned_counts(spark, sf_dir), "returned", "l_linestatus"), 6)


def _chisq_sql(row_expr: str, yates: bool) -> str:
    corr = "least(0.5, (SELECT min(abs(n - e)) FROM c))" if yates else "0"
    return f"""
WITH o AS (SELECT {row_expr} AS rw, l_linestatus AS cl, count(*) AS n FROM lineitem GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY rw) AS rt, sum(n) OVER (PARTITION BY cl) AS ct,
             sum(n) OVER () AS nn FROM o),
c AS (SELECT n, rt * ct / nn AS e FROM t)
SELECT round(sum(power(abs(n - e) - {corr}, 2) / e), 6) AS statistic,
       CAST((SELECT (count(DISTINCT rw) - 1) * (count(DISTINCT cl) - 1) FROM o) AS BIGINT) AS df
FROM c"""


SQL_CHISQ = _chisq_sql("l_returnflag", False)
SQL_CHISQ_YATES = _chisq_sql("CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END", True)


def q_welch_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.welch_stats(_li(spark, sf_dir), "l_quantity", "l_linestatus", ["F", "O"]), 6)


SQL_WELCH = """
WITH g AS (
  SELECT count(*) FILTER (WHERE l_linestatus = 'F') AS n0, avg(l_quantity) FILTER (WHERE l_linestatus = 'F') AS m0,
         var_samp(l_quantity) FILTER (WHERE l_linestatus = 'F') AS s0,
         count(*) FILTER (WHERE l_linestatus = 'O') AS n1, avg(l_quantity) FILTER (WHERE l_linestatus = 'O') AS m1,
         var_samp(l_quantity) FILTER (WHERE l_linestatus = 'O') AS s1 FROM lineitem)
SELECT round(m0, 6) AS mean_x, round(m1, 6) AS mean_y,
       round((m0 - m1) / sqrt(s0 / n0 + s1 / n1), 6) AS statistic,
       round(power(s0 / n0 + s1 / n1, 2) / (power(s0 / n0, 2) / (n0 - 1) + power(s1 / n1, 2) / (n1 - 1)), 6) AS df,
       round(sqrt(s0 / n0 + s1 / n1), 6) AS stderr, CAST(n0 AS BIGINT) AS n_x, CAST(n1 AS BIGINT) AS n_y
FROM g"""


def q_anova_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.anova_stats(_li(spark, sf_dir), "l_quantity", "l_returnflag"), 4)


def _anova_sql(src: str, value: str, group: str) -> str:
    return f"""
WITH s AS ({src}),
p AS (SELECT {group} AS g, count({value}) AS n, avg({value}) AS m, var_samp({value}) AS s2 FROM s
      WHERE {value} IS NOT NULL AND {group} IS NOT NULL GROUP BY 1),
t AS (SELECT sum(n) AS nn, sum(n * m) / sum(n) AS mm, count(*) AS k FROM p),
a AS (SELECT sum(n * power(m - mm, 2)) AS ssb, sum((n - 1) * coalesce(s2, 0)) AS ssw,
             any_value(k) - 1 AS d1, any_value(nn) - any_value(k) AS d2 FROM p, t)
SELECT CAST(d1 AS BIGINT) AS df_between, CAST(d2 AS BIGINT) AS df_within,
       round(ssb, 4) AS ss_between, round(ssw, 4) AS ss_within, round(ssb / d1, 4) AS ms_between,
       round(ssw / d2, 4) AS ms_within, round((ssb / d1) / (ssw / d2), 4) AS statistic
FROM a"""


SQL_ANOVA = _anova_sql("SELECT * FROM lineitem", "l_quantity", "l_returnflag")


def q_levene_stat(spark: SparkSession, sf_dir: str):
    return rounded(H.levene_stats(_li(spark, sf_dir), "l_quantity", "l_returnflag"), 4)


SQL_LEVENE = _anova_sql(
    "SELECT l_returnflag, abs(l_quantity - median(l_quantity) OVER (PARTITION BY l_returnflag)) AS dev "
    "FROM lineitem", "dev", "l_returnflag")


def _price_k(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderstatus", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("price_k"))


def _with_beta_sql(src: str, a: str, b: str, x: str, out: str) -> str:
    """``out`` over the rows of ``src`` with ``p`` = I_x(a, b)."""
    return f"""
WITH RECURSIVE src AS ({src}),
arg AS (SELECT *, row_number() OVER () AS _id, {a} AS _a, {b} AS _b, {x} AS _x FROM src),
side AS (SELECT *, _x < (_a + 1) / (_a + _b + 2) AS _near FROM arg),
pick AS (SELECT _id, CASE WHEN _near THEN _a ELSE _b END AS a, CASE WHEN _near THEN _b ELSE _a END AS b,
                CASE WHEN _near THEN _x ELSE 1 - _x END AS x FROM side),
cf AS (
  SELECT _id, a, b, x, 0::DOUBLE AS m, 1::DOUBLE AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d,
         1 / (1 - (a + b) * x / (a + 1)) AS h, 2::DOUBLE AS delta FROM pick
  UNION ALL
  SELECT _id, a, b, x, m, 1 + odd / c, 1 / (1 + odd * d), h * (1 + odd / c) / (1 + odd * d), (1 + odd / c) / (1 + odd * d)
  FROM (SELECT _id, a, b, x, m, 1 + even / c AS c, 1 / (1 + even * d) AS d, h * (1 + even / c) / (1 + even * d) AS h,
               -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m)) AS odd
        FROM (SELECT _id, a, b, x, m + 1 AS m, c, d, h, (m + 1) * (b - m - 1) * x / ((a + 1 + 2 * m) * (a + 2 + 2 * m)) AS even
              FROM cf WHERE abs(delta - 1) >= 1e-15 AND m < 5000))),
part AS (SELECT _id, arg_max(h, m) * exp(any_value(a * ln(x) + b * ln(1 - x) + lgamma(a + b) - lgamma(a) - lgamma(b))) / any_value(a) AS _v
         FROM cf GROUP BY _id),
tail AS (SELECT side.*, CASE WHEN _near THEN _v ELSE 1 - _v END AS p FROM side JOIN part USING (_id))
SELECT {out} FROM tail"""


def _with_t_sql(src: str, t: str, df: str, out: str) -> str:
    return _with_beta_sql(src, f"{df} / 2", "0.5", f"{df} / ({df} + {t} * {t})", out)


def _with_gamma_sql(src: str, shape: str, x: str, out: str) -> str:
    """``out`` over the rows of ``src`` with ``p`` = Q(shape, x)."""
    return f"""
WITH RECURSIVE src AS ({src}),
arg AS (SELECT *, row_number() OVER () AS _id, ({shape})::DOUBLE AS s, ({x})::DOUBLE AS x FROM src),
series AS (
  SELECT _id, s, x, 0::DOUBLE AS k, 1 / s AS delta, 1 / s AS h FROM arg WHERE x < s + 1
  UNION ALL
  SELECT _id, s, x, k + 1, delta * x / (s + k + 1), h + delta * x / (s + k + 1) FROM series WHERE delta >= h * 1e-16),
frac AS (
  SELECT _id, s, x, 0::DOUBLE AS k, 1e300::DOUBLE AS c, 1 / (x + 1 - s) AS d, 1 / (x + 1 - s) AS h, 2::DOUBLE AS delta FROM arg WHERE x >= s + 1
  UNION ALL
  SELECT _id, s, x, k, b + an / c, 1 / (b + an * d), h * (b + an / c) / (b + an * d), (b + an / c) / (b + an * d)
  FROM (SELECT *, -k * (k - s) AS an, x + 1 - s + 2 * k AS b
        FROM (SELECT _id, s, x, k + 1 AS k, c, d, h FROM frac WHERE abs(delta - 1) >= 1e-15 AND k < 5000))),
part AS (
  SELECT _id, 1 - max(h) * exp(any_value(-x + s * ln(x) - lgamma(s))) AS p FROM series GROUP BY _id
  UNION ALL
  SELECT _id, arg_max(h, k) * exp(any_value(-x + s * ln(x) - lgamma(s))) FROM frac GROUP BY _id),
tail AS (SELECT arg.* EXCLUDE (s, x), p FROM arg JOIN part USING (_id))
SELECT {out} FROM tail"""


def _horner_sql(coefs, x: str) -> str:
    text = repr(coefs[0])
    for c in coefs[1:]:
        text = f"({text} * {x} + {c!r})"
    return text


def _norm_ppf_sql(p: str) -> str:
    """The quantile's rational approximation for ``p`` in (0.5, 1)."""
    q, r = f"({p} - 0.5)", f"sqrt(-ln(1 - {p}))"
    near = f"{q} * {_horner_sql(normal._A, f'(0.180625 - {q} * {q})')} / {_horner_sql(normal._B, f'(0.180625 - {q} * {q})')}"
    mid = f"{_horner_sql(normal._C, f'({r} - 1.6)')} / {_horner_sql(normal._D, f'({r} - 1.6)')}"
    far = f"{_horner_sql(normal._E, f'({r} - 5.0)')} / {_horner_sql(normal._F, f'({r} - 5.0)')}"
    return f"CASE WHEN {q} <= 0.425 THEN {near} WHEN {r} <= 5 THEN {mid} ELSE {far} END"


def _lilliefors_p_sql(d: str, n: str) -> str:
    kd, nd = f"(CASE WHEN {n} <= 100 THEN {d} ELSE {d} * power({n} / 100.0, 0.49) END)", f"least({n}, 100)"
    small = (f"exp(-7.01256 * power({kd}, 2) * ({nd} + 2.78019) + 2.99587 * {kd} * sqrt({nd} + 2.78019) - 0.122119 "
             f"+ 0.974598 / sqrt({nd}) + 1.67997 / {nd})")
    k = f"((sqrt({n}) - 0.01 + 0.85 / sqrt({n})) * {d})"
    return f"""CASE WHEN {small} <= 0.1 THEN {small} WHEN {k} <= 0.302 THEN 1
  WHEN {k} <= 0.5 THEN 2.76773 - 19.828315 * {k} + 80.709644 * power({k}, 2) - 138.55152 * power({k}, 3) + 81.218052 * power({k}, 4)
  WHEN {k} <= 0.9 THEN -4.901232 + 40.662806 * {k} - 97.490286 * power({k}, 2) + 94.029866 * power({k}, 3) - 32.355711 * power({k}, 4)
  WHEN {k} <= 1.31 THEN 6.198765 - 19.55803 * {k} + 23.186922 * power({k}, 2) - 17.034965 * power({k}, 3) + 4.79535 * power({k}, 4)
  ELSE 0 END"""


_PRICE_K_SQL = "SELECT o_orderstatus, o_orderpriority, o_totalprice / 1000 AS price_k FROM orders"


def q_pearson_test(spark, sf_dir):
    return rounded(H.pearson_test(_li(spark, sf_dir), "l_quantity", "l_extendedprice"), 6)


SQL_PEARSON_TEST = _with_t_sql(
    """SELECT count(*) AS n, corr(l_quantity, l_extendedprice) AS r, r * sqrt((n - 2) / (1 - r * r)) AS t,
       (n - 2)::DOUBLE AS v FROM lineitem""", "t", "v",
    """CAST(n AS BIGINT) AS n, round(r, 6) AS estimate, round(t, 6) AS statistic, CAST(n - 2 AS BIGINT) AS df,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high, round(p, 6) AS p_value""")


def q_pearson_weak_test(spark, sf_dir):
    """A correlation that is not significant: the tail is far from 0."""
    return rounded(H.pearson_test(_li(spark, sf_dir), "l_quantity", "l_tax", ["l_returnflag"]), 6)


SQL_PEARSON_WEAK_TEST = _with_t_sql(
    """SELECT l_returnflag, count(*) AS n, corr(l_quantity, l_tax) AS r, r * sqrt((n - 2) / (1 - r * r)) AS t,
       (n - 2)::DOUBLE AS v FROM lineitem GROUP BY l_returnflag""", "t", "v",
    """l_returnflag, CAST(n AS BIGINT) AS n, round(r, 6) AS estimate, round(t, 6) AS statistic, CAST(n - 2 AS BIGINT) AS df,
       round(tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3)), 6) AS conf_low,
       round(tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3)), 6) AS conf_high, round(p, 6) AS p_value""")


def q_spearman_test(spark, sf_dir):
    s = H.spearman_test(_li(spark, sf_dir), "l_quantity", "l_extendedprice")
    n = F.col("n").cast("double")  # S relative to its maximum, as in spearman_stat
    return rounded(s.select("n", "estimate", (F.col("statistic") / ((n * n * n - n) / 3)).alias("statistic_rel"), "t", "df", "p_value"), 5)


SQL_SPEARMAN_TEST = _with_t_sql(
    """SELECT count(*) AS n, corr(ra, rb) AS r, r * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS v FROM (
         SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
                rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb
         FROM lineitem)""", "t", "v",
    """CAST(n AS BIGINT) AS n, round(r, 5) AS estimate, round((1 - r) / 2, 5) AS statistic_rel, round(t, 5) AS t,
       CAST(n - 2 AS BIGINT) AS df, round(p, 5) AS p_value""")


def q_spearman_small_test(spark, sf_dir):
    """Balances of customers and suppliers by region: five rows without ties."""
    nations = table(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("c"))
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.sum("s_acctbal").alias("s"))
    both = (nations.join(c, nations.n_nationkey == c.c_nationkey, "left").join(s, nations.n_nationkey == s.s_nationkey, "left")
            .groupBy("n_regionkey").agg(F.coalesce(F.sum("c"), F.lit(0.0)).alias("c"), F.coalesce(F.sum("s"), F.lit(0.0)).alias("s")))
    return rounded(H.spearman_test(both, "c", "s", exact=True).select("n", "estimate", "statistic", "p_value"), 6)


# The p-value by going through all permutations of the ranks.
SQL_SPEARMAN_SMALL_TEST = """
WITH RECURSIVE c AS (SELECT c_nationkey AS k, sum(c_acctbal) AS c FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, sum(s_acctbal) AS s FROM supplier GROUP BY 1),
b AS (SELECT n_regionkey, coalesce(sum(c), 0) AS c, coalesce(sum(s), 0) AS s
      FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN s ON s.k = n_nationkey GROUP BY 1),
r AS (SELECT rank() OVER (ORDER BY c) AS x, rank() OVER (ORDER BY s) AS y FROM b),
o AS (SELECT count(*) AS n, sum((x - y) * (x - y)) AS d FROM r),
p AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS used, 0::BIGINT AS d
      UNION ALL
      SELECT k + 1, list_append(used, x), p.d + (k + 1 - x) * (k + 1 - x) FROM p, (SELECT x FROM r) q WHERE NOT list_contains(used, x)),
t AS (SELECT p.d FROM p, o WHERE p.k = o.n)
SELECT any_value(n)::BIGINT AS n, round(1 - 6.0 * any_value(o.d) / (any_value(n) * (any_value(n) * any_value(n) - 1)), 6) AS estimate,
       any_value(o.d)::DOUBLE AS statistic,
       round(least(1.0::DOUBLE, 2.0::DOUBLE * CASE WHEN any_value(o.d) > (any_value(n) * any_value(n) * any_value(n) - any_value(n)) / 6.0
             THEN count(*) FILTER (t.d >= o.d) ELSE count(*) FILTER (t.d <= o.d) END / count(*)), 6) AS p_value
FROM t, o"""


def q_chisq_test(spark, sf_dir):
    return rounded(H.chisq_test(_returned_counts(spark, sf_dir), "returned", "l_linestatus"), 6)


SQL_CHISQ_TEST = _with_gamma_sql(SQL_CHISQ_YATES, "df / 2", "statistic / 2", "statistic, df, round(p, 6) AS p_value")


def q_chisq_segment_test(spark, sf_dir):
    """Priority by status: independent columns, a tail far from 0."""
    o = table(spark, sf_dir, "orders")
    levels = [["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["F", "O", "P"]]
    return rounded(H.chisq_test(D.contingency(o, "o_orderpriority", "o_orderstatus", *levels), "o_orderpriority", "o_orderstatus"), 6)


SQL_CHISQ_SEGMENT_TEST = _with_gamma_sql(
    """WITH o AS (SELECT o_orderpriority AS rw, o_orderstatus AS cl, count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY rw) AS rt, sum(n) OVER (PARTITION BY cl) AS ct, sum(n) OVER () AS nn FROM o)
SELECT sum(power(n - rt * ct / nn, 2) / (rt * ct / nn)) AS statistic,
       CAST((SELECT (count(DISTINCT rw) - 1) * (count(DISTINCT cl) - 1) FROM o) AS BIGINT) AS df FROM t""",
    "df / 2", "statistic / 2", "round(statistic, 6) AS statistic, df, round(p, 6) AS p_value")


def q_welch_test(spark, sf_dir):
    return rounded(H.welch_test(_li(spark, sf_dir), "l_quantity", "l_linestatus", ["F", "O"]), 6)


# the t quantile of the interval by its expansion in 1 / df (df is in the thousands)
SQL_WELCH_TEST = _with_t_sql(
    """SELECT *, (m0 - m1) / se AS t,
         z + (power(z, 3) + z) / 4 / v + (5 * power(z, 5) + 16 * power(z, 3) + 3 * z) / 96 / v / v
           + (3 * power(z, 7) + 19 * power(z, 5) + 17 * power(z, 3) - 15 * z) / 384 / power(v, 3) AS q FROM (
         SELECT *, 1.959963984540054 AS z, sqrt(s0 / n0 + s1 / n1) AS se,
           power(s0 / n0 + s1 / n1, 2) / (power(s0 / n0, 2) / (n0 - 1) + power(s1 / n1, 2) / (n1 - 1)) AS v FROM (
           SELECT count(*) FILTER (l_linestatus = 'F') AS n0, avg(l_quantity) FILTER (l_linestatus = 'F') AS m0,
             var_samp(l_quantity) FILTER (l_linestatus = 'F') AS s0, count(*) FILTER (l_linestatus = 'O') AS n1,
             avg(l_quantity) FILTER (l_linestatus = 'O') AS m1, var_samp(l_quantity) FILTER (l_linestatus = 'O') AS s1 FROM lineitem))""", "t", "v",
    """round(m0, 6) AS mean_x, round(m1, 6) AS mean_y, round(t, 6) AS statistic, round(v, 6) AS df, round(se, 6) AS stderr,
       CAST(n0 AS BIGINT) AS n_x, CAST(n1 AS BIGINT) AS n_y, round(p, 6) AS p_value,
       round(m0 - m1 - q * se, 6) AS conf_low, round(m0 - m1 + q * se, 6) AS conf_high""")


def _with_f_sql(src: str) -> str:
    return _with_beta_sql(
        src, "df_within / 2", "df_between / 2", "df_within / (df_within + df_between * f)",
        "df_between, df_within, ss_between, ss_within, ms_between, ms_within, statistic, round(p, 6) AS p_value")


def _anova_test_sql(src: str, value: str, group: str) -> str:
    return _with_f_sql(_anova_sql(src, value, group).replace("AS statistic", "AS statistic, (ssb / d1) / (ssw / d2) AS f"))


def q_anova_test(spark, sf_dir):
    return rounded(H.anova_test(_price_k(spark, sf_dir), "price_k", "o_orderpriority"), 4, {"p_value": 6})


SQL_ANOVA_TEST = _anova_test_sql(_PRICE_K_SQL, "price_k", "o_orderpriority")


def q_levene_test(spark, sf_dir):
    return rounded(H.levene_test(_price_k(spark, sf_dir), "price_k", "o_orderpriority"), 4, {"p_value": 6})


SQL_LEVENE_TEST = _anova_test_sql(
    f"SELECT o_orderpriority, abs(price_k - median(price_k) OVER (PARTITION BY o_orderpriority)) AS dev FROM ({_PRICE_K_SQL})", "dev", "o_orderpriority")


def q_fligner_test(spark, sf_dir):
    return rounded(H.fligner_test(_price_k(spark, sf_dir), "price_k", "o_orderpriority"), 6)


SQL_FLIGNER_TEST = _with_gamma_sql(
    f"""WITH dev AS (SELECT o_orderpriority AS g, abs(price_k - median(price_k) OVER (PARTITION BY o_orderpriority)) AS x FROM ({_PRICE_K_SQL})),
ranked AS (SELECT g, (1 + (rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0) / (count(*) OVER () + 1)) / 2 AS u FROM dev),
score AS (SELECT g, {_norm_ppf_sql("u")} AS a FROM ranked),
per AS (SELECT count(*) AS k, sum(a) AS s FROM score GROUP BY g),
one AS (SELECT count(*) AS n, avg(a) AS m, var_samp(a) AS va FROM score)
SELECT ((SELECT sum(s * s / k) FROM per) - n * m * m) / va AS statistic, (SELECT count(*) - 1 FROM per) AS df FROM one""",
    "df / 2", "statistic / 2", "round(statistic, 6) AS statistic, CAST(df AS BIGINT) AS df, round(p, 6) AS p_value")


def q_lilliefors_test(spark, sf_dir):
    o = _price_k(spark, sf_dir).withColumn("sqrt_price_k", F.sqrt("price_k"))
    return rounded(H.lilliefors_test(o, "sqrt_price_k"), 8)


def q_lilliefors_by_status(spark, sf_dir):
    """Split-apply: the normality test in every group."""
    return rounded(H.lilliefors_test(_price_k(spark, sf_dir), "price_k", ["o_orderstatus"]), 8)


def q_lilliefors_stat(spark, sf_dir):
    """D statistic per order status (p-values: ``lilliefors_by_status``)."""
    return rounded(H.lilliefors_stats(_price_k(spark, sf_dir), "price_k", ["o_orderstatus"]), 8)


# brute force: every row's position, and the same normal CDF polynomial in SQL
SQL_LILLIEFORS = """
WITH s AS (SELECT o_orderstatus AS g, o_totalprice / 1000 AS x FROM orders),
m AS (SELECT g, avg(x) AS mu, stddev_samp(x) AS sd, count(*) AS n FROM s GROUP BY g),
r AS (SELECT s.g, x, n, row_number() OVER (PARTITION BY s.g ORDER BY x) AS i, (x - mu) / sd AS z
      FROM s JOIN m ON s.g = m.g),
a AS (SELECT *, abs(z) AS az, exp(-abs(z) * abs(z) / 2) AS e FROM r),
t AS (SELECT *, CASE WHEN az > 37 THEN 0.0
                     WHEN az < 7.07106781186547 THEN
                       e * ((((((0.0352624965998911 * az + 0.700383064443688) * az + 6.37396220353165) * az
                              + 33.912866078383) * az + 112.079291497871) * az + 221.213596169931) * az
                              + 220.206867912376)
                         / (((((((0.0883883476483184 * az + 1.75566716318264) * az + 16.064177579207) * az
                               + 86.7807322029461) * az + 296.564248779674) * az + 637.333633378831) * az
                               + 793.826512519948) * az + 440.413735824752)
                     ELSE e / (az + 1 / (az + 2 / (az + 3 / (az + 4 / (az + 0.65))))) / 2.506628274631 END AS tail
      FROM a),
p AS (SELECT *, CASE WHEN z > 0 THEN 1 - tail ELSE tail END AS phi FROM t)
SELECT g AS o_orderstatus, round(max(greatest(i / n - phi, phi - (i - 1) / n)), 8) AS statistic,
       CAST(any_value(n) AS BIGINT) AS n
FROM p GROUP BY g"""


def _lilliefors_test_sql(value: str, group: str) -> str:
    """The twin of the statistic, unrounded, with its p-value."""
    stat = SQL_LILLIEFORS.replace("o_orderstatus AS g, o_totalprice / 1000 AS x", f"{group} AS g, {value} AS x").replace(
        "round(max(greatest(i / n - phi, phi - (i - 1) / n)), 8)", "max(greatest(i / n - phi, phi - (i - 1) / n))")
    return f"SELECT o_orderstatus, round(statistic, 8) AS statistic, n, round({_lilliefors_p_sql('statistic', 'n')}, 8) AS p_value FROM ({stat})"


SQL_LILLIEFORS_BY_STATUS = _lilliefors_test_sql("o_totalprice / 1000", "o_orderstatus")
SQL_LILLIEFORS_TEST = f"SELECT * EXCLUDE (o_orderstatus) FROM ({_lilliefors_test_sql('sqrt(o_totalprice / 1000)', '1')})"


def q_correlation_matrix(spark, sf_dir):
    li = _li(spark, sf_dir).select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rounded(H.correlation_matrix(li, li.columns), 6)


def q_correlation_matrix_stat(spark, sf_dir):
    """Pairwise r, n, t, df of four columns (p-values: ``correlation_matrix``)."""
    li = _li(spark, sf_dir).select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rounded(H.correlation_matrix(li, li.columns).drop("p_value"), 6)


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"),
          ("l_extendedprice", "l_discount"), ("l_extendedprice", "l_tax"), ("l_discount", "l_tax")]
SQL_CORR_MATRIX = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, CAST(count(*) AS BIGINT) AS n, round(corr({a}, {b}), 6) AS r, "
    f"round(corr({a}, {b}) * sqrt((count(*) - 2) / (1 - power(corr({a}, {b}), 2))), 6) AS t, "
    f"CAST(count(*) - 2 AS BIGINT) AS df FROM lineitem" for a, b in _PAIRS)

SQL_CORR_MATRIX_TEST = _with_t_sql("\nUNION ALL\n".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, count(*) AS n, corr({a}, {b}) AS r, r * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS v FROM lineitem" for a, b in _PAIRS),
    "t", "v", "var1, var2, CAST(n AS BIGINT) AS n, round(r, 6) AS r, round(t, 6) AS t, CAST(n - 2 AS BIGINT) AS df, round(p, 6) AS p_value")

QUERIES = {
    "pearson_stat": q_pearson_stat,
    "pearson_by_flag_stat": q_pearson_by_flag_stat,
    "spearman_stat": q_spearman_stat,
    "chisq_stat": q_chisq_stat,
    "chisq_yates_stat": q_chisq_yates_stat,
    "welch_stat": q_welch_stat,
    "anova_stat": q_anova_stat,
    "levene_stat": q_levene_stat,
    "pearson_test": q_pearson_test,
    "pearson_weak_test": q_pearson_weak_test,
    "chisq_segment_test": q_chisq_segment_test,
    "spearman_test": q_spearman_test,
    "spearman_small_test": q_spearman_small_test,
    "chisq_test": q_chisq_test,
    "welch_test": q_welch_test,
    "anova_test": q_anova_test,
    "levene_test": q_levene_test,
    "fligner_test": q_fligner_test,
    "lilliefors_test": q_lilliefors_test,
    "lilliefors_by_status": q_lilliefors_by_status,
    "correlation_matrix": q_correlation_matrix,
    "correlation_matrix_stat": q_correlation_matrix_stat,
    "lilliefors_stat": q_lilliefors_stat,
}
SQL = {
    "pearson_stat": SQL_PEARSON,
    "pearson_by_flag_stat": SQL_PEARSON_BY_FLAG,
    "spearman_stat": SQL_SPEARMAN,
    "chisq_stat": SQL_CHISQ,
    "chisq_yates_stat": SQL_CHISQ_YATES,
    "welch_stat": SQL_WELCH,
    "anova_stat": SQL_ANOVA,
    "levene_stat": SQL_LEVENE,
    "correlation_matrix_stat": SQL_CORR_MATRIX,
    "lilliefors_stat": SQL_LILLIEFORS,
    "pearson_test": SQL_PEARSON_TEST,
    "pearson_weak_test": SQL_PEARSON_WEAK_TEST,
    "chisq_segment_test": SQL_CHISQ_SEGMENT_TEST,
    "spearman_test": SQL_SPEARMAN_TEST,
    "spearman_small_test": SQL_SPEARMAN_SMALL_TEST,
    "chisq_test": SQL_CHISQ_TEST,
    "welch_test": SQL_WELCH_TEST,
    "anova_test": SQL_ANOVA_TEST,
    "levene_test": SQL_LEVENE_TEST,
    "fligner_test": SQL_FLIGNER_TEST,
    "lilliefors_test": SQL_LILLIEFORS_TEST,
    "lilliefors_by_status": SQL_LILLIEFORS_BY_STATUS,
    "correlation_matrix": SQL_CORR_MATRIX_TEST,
}

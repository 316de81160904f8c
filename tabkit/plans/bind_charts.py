"""Chart data bound to ``orders`` (o_totalprice in thousands x o_orderstatus)."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tabkit.functions.normal import norm_ppf_sql
from tabkit.operators import charts as V
from tabkit.plans.bind_describe import rounded
from tabkit.plans.tables import table


def _o(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("price_k"))


def q_histogram(spark: SparkSession, sf_dir: str):
    return rounded(V.histogram(_o(spark, sf_dir), "price_k", 20), 6)


def _hist_sql(fill: str | None) -> str:
    k = f"{fill}, " if fill else ""
    part = f"PARTITION BY {fill}" if fill else ""
    return f"""
WITH r AS (SELECT min(o_totalprice / 1000) AS lo, max(o_totalprice / 1000) AS hi FROM orders),
b AS (SELECT {k}least(CAST(floor((o_totalprice / 1000 - lo) / ((hi - lo) / 20)) AS BIGINT) + 1, 20) AS bin,
             lo, (hi - lo) / 20 AS w FROM orders, r),
c AS (SELECT {k}bin, count(*) AS n, any_value(lo) AS lo, any_value(w) AS w FROM b GROUP BY ALL)
SELECT {k}CAST(bin AS INTEGER) AS bin, round(lo + (bin - 1) * w, 6) AS left, round(lo + (bin - 1) * w + w, 6) AS right,
       round(lo + (bin - 1) * w + w / 2, 6) AS mid, CAST(n AS BIGINT) AS n,
       round(n / (sum(n) OVER ({part}) * w), 6) AS density
FROM c"""


SQL_HISTOGRAM = _hist_sql(None)


def q_histogram_by_status(spark: SparkSession, sf_dir: str):
    return rounded(V.histogram(_o(spark, sf_dir), "price_k", 20, fill="o_orderstatus"), 6)


SQL_HISTOGRAM_BY_STATUS = _hist_sql("o_orderstatus")


def q_normal_overlay(spark: SparkSession, sf_dir: str):
    o = _o(spark, sf_dir)
    return rounded(V.normal_overlay(V.histogram(o, "price_k", 20), o, "price_k")
                   .select("bin", "mid", "normal_density"), 8)


SQL_NORMAL_OVERLAY = """
WITH r AS (SELECT min(o_totalprice / 1000) AS lo, max(o_totalprice / 1000) AS hi,
                  avg(o_totalprice / 1000) AS mu, stddev_samp(o_totalprice / 1000) AS sd FROM orders),
b AS (SELECT DISTINCT least(CAST(floor((o_totalprice / 1000 - lo) / ((hi - lo) / 20)) AS BIGINT) + 1, 20) AS bin
      FROM orders, r)
SELECT CAST(bin AS INTEGER) AS bin, round(lo + (bin - 1) * ((hi - lo) / 20) + ((hi - lo) / 20) / 2, 8) AS mid,
       round(exp(-power((lo + (bin - 1) * ((hi - lo) / 20) + ((hi - lo) / 20) / 2 - mu) / sd, 2) / 2)
             / (sd * sqrt(2 * pi())), 8) AS normal_density
FROM b, r"""


def q_qq_points(spark: SparkSession, sf_dir: str):
    return rounded(V.qq_points(_o(spark, sf_dir), "price_k", ["o_orderstatus"]), 6)


def q_qq_positions(spark: SparkSession, sf_dir: str):
    """Q-Q inputs checkable in SQL: order position and plotting position."""
    return rounded(V.qq_positions(_o(spark, sf_dir), "price_k", ["o_orderstatus"]).withColumnRenamed("sample", "price_k"), 8)


SQL_QQ_POSITIONS = """
SELECT o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS BIGINT) AS i,
       round(o_totalprice / 1000, 8) AS price_k,
       round((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) - a)
             / (count(*) OVER (PARTITION BY o_orderstatus) + 1 - 2 * a), 8) AS plotting_position
FROM (SELECT *, CASE WHEN count(*) OVER (PARTITION BY o_orderstatus) <= 10 THEN 0.375 ELSE 0.5 END AS a
      FROM orders)"""
SQL_QQ_POINTS = f"""
SELECT o_orderstatus, i, round({norm_ppf_sql('pp')}, 6) AS theoretical, round(price_k, 6) AS sample FROM (
  SELECT o_orderstatus, i, o_totalprice / 1000 AS price_k, (i - a) / (n + 1 - 2 * a) AS pp FROM (
    SELECT *, CASE WHEN n <= 10 THEN 0.375::DOUBLE ELSE 0.5::DOUBLE END AS a FROM (
      SELECT o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS i,
             count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)))"""


def q_qq_line(spark: SparkSession, sf_dir: str):
    return rounded(V.qq_line(_o(spark, sf_dir), "price_k", ["o_orderstatus"]), 8)


SQL_QQ_LINE = """
SELECT o_orderstatus,
       round((quantile_cont(o_totalprice / 1000, 0.75) - quantile_cont(o_totalprice / 1000, 0.25)) / (2 * 0.6744897501960817), 8) AS slope,
       round(quantile_cont(o_totalprice / 1000, 0.25) + 0.6744897501960817
             * (quantile_cont(o_totalprice / 1000, 0.75) - quantile_cont(o_totalprice / 1000, 0.25)) / (2 * 0.6744897501960817), 8) AS intercept
FROM orders GROUP BY 1"""


def q_box_stats(spark: SparkSession, sf_dir: str):
    stats, _ = V.box_stats(_o(spark, sf_dir), "price_k", "o_orderpriority")
    return rounded(stats, 6)


def q_box_outliers(spark: SparkSession, sf_dir: str):
    """Outlying values (beyond 1.5 hinge spreads) of a skewed measure."""
    d = table(spark, sf_dir, "documents").select("lang", F.col("n_chars").cast("double").alias("n_chars"))
    _, out = V.box_stats(d, "n_chars", "lang")
    return rounded(out, 6)


_FIVENUM_TMPL = """
WITH s AS (SELECT {g} AS g, {v} AS v,
                  row_number() OVER (PARTITION BY {g} ORDER BY {v}) AS i,
                  count(*) OVER (PARTITION BY {g}) AS n FROM {t}),
d AS (SELECT DISTINCT g, n, floor((n + 3) / 2) / 2 AS n4 FROM s),
f AS (SELECT d.g, d.n,
        (max(CASE WHEN i = 1 THEN v END)) AS mn,
        (max(CASE WHEN i = floor(n4) THEN v END) + max(CASE WHEN i = ceil(n4) THEN v END)) / 2 AS lh,
        (max(CASE WHEN i = floor((d.n + 1) / 2) THEN v END) + max(CASE WHEN i = ceil((d.n + 1) / 2) THEN v END)) / 2 AS md,
        (max(CASE WHEN i = floor(d.n + 1 - n4) THEN v END) + max(CASE WHEN i = ceil(d.n + 1 - n4) THEN v END)) / 2 AS uh,
        max(CASE WHEN i = d.n THEN v END) AS mx
      FROM s JOIN d ON s.g = d.g GROUP BY d.g, d.n),
w AS (SELECT f.g, min(CASE WHEN v >= lh - 1.5 * (uh - lh) AND v <= uh + 1.5 * (uh - lh) THEN v END) AS wl,
             max(CASE WHEN v >= lh - 1.5 * (uh - lh) AND v <= uh + 1.5 * (uh - lh) THEN v END) AS wh,
             sum(CASE WHEN v >= lh - 1.5 * (uh - lh) AND v <= uh + 1.5 * (uh - lh) THEN 0 ELSE 1 END) AS no
      FROM s JOIN f ON s.g = f.g GROUP BY f.g)"""
_FIVENUM_SQL = _FIVENUM_TMPL.format(g="o_orderpriority", v="o_totalprice / 1000", t="orders")

SQL_BOX_STATS = _FIVENUM_SQL + """
SELECT f.g AS o_orderpriority, CAST(f.n AS BIGINT) AS n, round(mn, 6) AS min, round(lh, 6) AS lower_hinge,
       round(md, 6) AS median, round(uh, 6) AS upper_hinge, round(mx, 6) AS max,
       round(wl, 6) AS whisker_low, round(wh, 6) AS whisker_high, CAST(no AS BIGINT) AS n_outliers
FROM f JOIN w ON f.g = w.g"""


SQL_BOX_OUTLIERS = _FIVENUM_TMPL.format(g="lang", v="CAST(n_chars AS DOUBLE)", t="documents") + """
SELECT s.g AS lang, round(v, 6) AS n_chars, CAST(count(*) AS BIGINT) AS n
FROM s JOIN f ON s.g = f.g
WHERE NOT (v >= lh - 1.5 * (uh - lh) AND v <= uh + 1.5 * (uh - lh))
GROUP BY s.g, v"""


def q_scatter(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    return V.scatter(li, "l_quantity", "l_extendedprice", "l_returnflag")


SQL_SCATTER = "SELECT l_quantity, l_extendedprice, l_returnflag FROM lineitem"

QUERIES = {
    "histogram": q_histogram,
    "histogram_by_status": q_histogram_by_status,
    "normal_overlay": q_normal_overlay,
    "qq_points": q_qq_points,
    "qq_positions": q_qq_positions,
    "qq_line": q_qq_line,
    "box_stats": q_box_stats,
    "box_outliers": q_box_outliers,
    "scatter": q_scatter,
}
SQL = {
    "histogram": SQL_HISTOGRAM,
    "histogram_by_status": SQL_HISTOGRAM_BY_STATUS,
    "normal_overlay": SQL_NORMAL_OVERLAY,
    "qq_points": SQL_QQ_POINTS,
    "qq_positions": SQL_QQ_POSITIONS,
    "qq_line": SQL_QQ_LINE,
    "box_stats": SQL_BOX_STATS,
    "box_outliers": SQL_BOX_OUTLIERS,
    "scatter": SQL_SCATTER,
}

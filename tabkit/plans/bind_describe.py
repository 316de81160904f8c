"""Descriptive statistics, frequency/contingency tables and order-based
measures bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tabkit.functions import columns as X
from tabkit.operators import describe as D
from tabkit.operators import order as O
from tabkit.plans.bind_columns import PRICE_BREAKS, PRICE_LABELS, _CUSTOMER_GAPS_SQL, _customer_with_gaps
from tabkit.plans.tables import table


def rounded(df: DataFrame, digits: int = 4, per_column: dict | None = None) -> DataFrame:
    """Round every double column (oracle comparison is by value hash).
    ``per_column`` overrides the digits of single columns."""
    per_column = per_column or {}
    return df.select(*[F.round(F.col(f.name), per_column.get(f.name, digits)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _price_k(spark, sf_dir):
    """orders with the total price in thousands (moderate magnitudes keep
    rounded comparisons stable)."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority", "o_orderstatus",
                    (F.col("o_totalprice") / 1000).alias("price_k"))


# price_k has 5 decimals and type-7 interpolation adds two more: 8 decimals
# never fall on a decimal tie (where HALF_UP on the decimal text and
# rounding of the binary value legitimately differ).
PRICE_DIGITS = 8


def q_describe_price(spark: SparkSession, sf_dir: str):
    return rounded(D.describe_column(_price_k(spark, sf_dir), "price_k"), PRICE_DIGITS)


def q_describe_price_by_priority(spark: SparkSession, sf_dir: str):
    return rounded(D.describe_column(_price_k(spark, sf_dir), "price_k", ["o_orderpriority"]), PRICE_DIGITS)


def q_describe_quantity_by_flag(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    return rounded(D.describe_column(li, "l_quantity", ["l_returnflag"]))


def _describe_sql(src: str, col: str, keys: list[str], digits: int = 4) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    gb = f"GROUP BY {k}" if keys else ""
    part = f"PARTITION BY {k}" if keys else ""
    on = " AND ".join(f"a.{x} IS NOT DISTINCT FROM b.{x}" for x in keys) or "TRUE"
    sel_keys = ", ".join(f"a.{x}" for x in keys)
    sel_keys = (sel_keys + ", ") if keys else ""
    return f"""
WITH src AS ({src}),
m AS (
  SELECT {kc}CAST(count({col}) AS BIGINT) AS n,
         CAST(sum(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
         avg({col}) AS mean, min({col}) AS min, max({col}) AS max,
         var_samp({col}) AS var, stddev_samp({col}) AS sd,
         avg(ln(CASE WHEN {col} > 0 THEN {col} END)) AS mlog,
         avg(1.0 / {col}) AS minv,
         quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.4) AS p40,
         quantile_cont({col}, 0.5) AS median, quantile_cont({col}, 0.75) AS q3
  FROM src {gb}),
c AS (SELECT {kc}avg({col}) AS mu FROM src {gb}),
k AS (
  SELECT {kc}avg(power(s.{col} - c.mu, 4)) AS m4, avg(power(s.{col} - c.mu, 2)) AS m2
  FROM src s {('JOIN c USING (' + k + ')') if keys else 'CROSS JOIN c'} {gb}),
vc AS (SELECT {kc}{col} AS v, count(*) AS cnt FROM src WHERE {col} IS NOT NULL GROUP BY {kc}{col}),
md AS (SELECT {kc}v AS mode, CAST(cnt AS BIGINT) AS mode_n FROM (
         SELECT *, row_number() OVER ({part} ORDER BY cnt DESC, v) AS rn FROM vc) WHERE rn = 1),
tr AS (SELECT {kc}avg({col}) AS tm FROM (
         SELECT {kc}{col}, row_number() OVER ({part} ORDER BY {col}) AS rn,
                count(*) OVER ({part}) AS nn
         FROM src WHERE {col} IS NOT NULL)
       WHERE rn > floor(nn * 0.1) AND rn <= nn - floor(nn * 0.1) {gb})
SELECT {sel_keys}a.n, a.nulls, round(a.mean, {digits}) AS mean, round(a.min, {digits}) AS min, round(a.max, {digits}) AS max,
       round((a.min + a.max) / 2, {digits}) AS mid_range, round(a.max - a.min, {digits}) AS range,
       round(a.var, {digits}) AS var, round(a.sd, {digits}) AS sd, round(a.sd / a.mean * 100, {digits}) AS cv_pct,
       round(round_even(CASE WHEN a.min < 0 THEN NULL WHEN a.min = 0 THEN 0 ELSE exp(a.mlog) END, 2), {digits}) AS geo_mean,
       round(round_even(CASE WHEN a.min = 0 THEN 0 ELSE 1.0 / a.minv END, 2), {digits}) AS harm_mean,
       round((b.m4 / (b.m2 * b.m2)) * power(1 - 1.0 / a.n, 2) - 3, {digits}) AS kurtosis,
       round(b.m4 / (b.m2 * b.m2) - 3, {digits}) AS kurtosis_pop,
       round(a.q1, {digits}) AS q1, round(a.p40, {digits}) AS p40, round(a.median, {digits}) AS median, round(a.q3, {digits}) AS q3,
       round(d.mode, {digits}) AS mode, d.mode_n,
       round(round_even(t.tm, 2), {digits}) AS trimmed_mean,
       round(round_even((a.q1 + 2 * a.median + a.q3) / 4, 2), {digits}) AS trimean,
       round(a.q3 - a.q1, {digits}) AS iqr
FROM m a JOIN k b ON {on} JOIN md d ON {on.replace('b.', 'd.')} JOIN tr t ON {on.replace('b.', 't.')}"""


_PRICE_K_SQL = ("SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice / 1000 AS price_k "
                "FROM orders")

SQL_DESCRIBE_PRICE = _describe_sql(_PRICE_K_SQL, "price_k", [], PRICE_DIGITS)
SQL_DESCRIBE_PRICE_BY_PRIORITY = _describe_sql(_PRICE_K_SQL, "price_k", ["o_orderpriority"], PRICE_DIGITS)
SQL_DESCRIBE_QUANTITY_BY_FLAG = _describe_sql("SELECT * FROM lineitem", "l_quantity", ["l_returnflag"])


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_summary_lineitem(spark: SparkSession, sf_dir: str):
    return rounded(D.summary_table(table(spark, sf_dir, "lineitem"), _LI_NUM))


def _union_per_column(template: str, cols) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


SQL_SUMMARY_LINEITEM = _union_per_column(
    "SELECT '{c}' AS column, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, "
    "round(quantile_cont({c}, 0.5), 4) AS median, round(avg({c}), 4) AS mean, "
    "round(quantile_cont({c}, 0.75), 4) AS q3, round(max({c}), 4) AS max, "
    "CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls FROM lineitem", _LI_NUM)


def q_describe_lineitem(spark: SparkSession, sf_dir: str):
    return rounded(D.describe_table(table(spark, sf_dir, "lineitem"), _LI_NUM))


SQL_DESCRIBE_LINEITEM = _union_per_column(
    "SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean, "
    "round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, "
    "round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, "
    "round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4) AS max FROM lineitem", _LI_NUM)


SKETCH_ERROR = 0.002
_SKETCHED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SKETCH_PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def q_summary_sketched(spark: SparkSession, sf_dir: str):
    """The summary from sketches, each quartile held against the exact
    quantiles one rank error below and above it."""
    li = table(spark, sf_dir, "lineitem")
    s = D.summary_table(li, _SKETCHED, approx=SKETCH_ERROR)
    bounds = None
    for c in _SKETCHED:
        # twice the error: interpolated bounds lie up to one row inside
        probs = [p + e for p in _SKETCH_PROBS.values() for e in (-2 * SKETCH_ERROR, 2 * SKETCH_ERROR)]
        b = D.quantiles(li, c, probs, names=[f"{n}_{side}" for n in _SKETCH_PROBS for side in ("low", "high")])
        b = b.withColumn("column", F.lit(c))
        bounds = b if bounds is None else bounds.unionByName(b)
    j = s.join(bounds, "column")
    return rounded(j.select("column", "min", "mean", "max", "nulls", *(f"{n}_{side}" for n in _SKETCH_PROBS for side in ("low", "high")),
                            *(F.col(n).between(F.col(f"{n}_low"), F.col(f"{n}_high")).alias(f"{n}_within") for n in _SKETCH_PROBS)), 4)


SQL_SUMMARY_SKETCHED = "\nUNION ALL\n".join(
    "SELECT '" + c + f"' AS \"column\", round(min({c}), 4) AS min, round(avg({c}), 4) AS mean, round(max({c}), 4) AS max, count(*) - count({c}) AS nulls, "
    + ", ".join(f"round(quantile_cont({c}, {p - 2 * SKETCH_ERROR}), 4) AS {n}_low, round(quantile_cont({c}, {p + 2 * SKETCH_ERROR}), 4) AS {n}_high, "
                f"quantile_cont({c}, {p}) BETWEEN quantile_cont({c}, {p - 2 * SKETCH_ERROR}) AND quantile_cont({c}, {p + 2 * SKETCH_ERROR}) AS {n}_within"
                for n, p in _SKETCH_PROBS.items()) + " FROM lineitem" for c in _SKETCHED)


def q_missing_total(spark: SparkSession, sf_dir: str):
    return D.missing_total(_customer_with_gaps(spark, sf_dir))


SQL_MISSING_TOTAL = f"""
SELECT CAST(sum((c_custkey IS NULL)::INT + (segment IS NULL)::INT + (nation IS NULL)::INT
                + (balance IS NULL)::INT) AS BIGINT) AS missing_cells
FROM {_CUSTOMER_GAPS_SQL} t"""


def q_missing_share(spark: SparkSession, sf_dir: str):
    return rounded(D.missing_share(_customer_with_gaps(spark, sf_dir)), 6)


SQL_MISSING_SHARE = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, CAST(sum(({c} IS NULL)::INT) AS BIGINT) AS missing, "
    f"round(sum(({c} IS NULL)::INT) / count(*), 6) AS share FROM {_CUSTOMER_GAPS_SQL} t"
    for c in ["c_custkey", "segment", "nation", "balance"])


def q_missing_patterns(spark: SparkSession, sf_dir: str):
    return D.missing_patterns(_customer_with_gaps(spark, sf_dir))


SQL_MISSING_PATTERNS = f"""
SELECT c_custkey IS NULL AS c_custkey_missing, segment IS NULL AS segment_missing,
       nation IS NULL AS nation_missing, balance IS NULL AS balance_missing,
       CAST(count(*) AS BIGINT) AS n
FROM {_CUSTOMER_GAPS_SQL} t GROUP BY ALL"""


def q_freq_size(spark: SparkSession, sf_dir: str):
    return rounded(O.frequency_table(table(spark, sf_dir, "part"), "p_size"), 6)


SQL_FREQ_SIZE = """
WITH c AS (SELECT p_size, count(*) AS n FROM part GROUP BY p_size)
SELECT p_size, CAST(n AS BIGINT) AS n, round(100.0 * n / sum(n) OVER (), 6) AS p,
       round(100.0 * sum(n) OVER (ORDER BY p_size NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(n) OVER (), 6) AS cum_p,
       CAST(sum(n) OVER (ORDER BY p_size NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
       CAST(sum(n) OVER () AS BIGINT) AS total
FROM c"""


def q_freq_segment_by_nation(spark: SparkSession, sf_dir: str):
    """Frequency table per group, with a NULL group (ordered last)."""
    c = _customer_with_gaps(spark, sf_dir).withColumn("region_of_nation", F.col("nation") % 5)
    return rounded(O.frequency_table(c, "segment", ["region_of_nation"]), 6)


SQL_FREQ_SEGMENT_BY_NATION = f"""
WITH t AS (SELECT segment, nation % 5 AS region_of_nation FROM {_CUSTOMER_GAPS_SQL} x),
c AS (SELECT region_of_nation, segment, count(*) AS n FROM t GROUP BY ALL)
SELECT region_of_nation, segment, CAST(n AS BIGINT) AS n,
       round(100.0 * n / sum(n) OVER (PARTITION BY region_of_nation), 6) AS p,
       round(100.0 * sum(n) OVER (PARTITION BY region_of_nation ORDER BY segment NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(n) OVER (PARTITION BY region_of_nation), 6) AS cum_p,
       CAST(sum(n) OVER (PARTITION BY region_of_nation ORDER BY segment NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
       CAST(sum(n) OVER (PARTITION BY region_of_nation) AS BIGINT) AS total
FROM c"""


def q_level_counts_price(spark: SparkSession, sf_dir: str):
    o = table(spark, sf_dir, "orders").withColumn(
        "price_level", X.cut("o_totalprice", PRICE_BREAKS, PRICE_LABELS))
    return D.level_counts(o, "price_level", PRICE_LABELS)


SQL_LEVEL_COUNTS_PRICE = """
WITH lv AS (SELECT * FROM (VALUES (1, 'bajo'), (2, 'medio'), (3, 'alto')) v(level_no, price_level)),
o AS (SELECT CASE WHEN o_totalprice > 10000 AND o_totalprice <= 81000 THEN 'bajo'
                  WHEN o_totalprice > 81000 AND o_totalprice <= 162000 THEN 'medio'
                  WHEN o_totalprice > 162000 AND o_totalprice <= 400000 THEN 'alto' END AS price_level
      FROM orders)
SELECT lv.level_no, lv.price_level, CAST(count(o.price_level) AS BIGINT) AS n
FROM lv LEFT JOIN o ON lv.price_level = o.price_level GROUP BY lv.level_no, lv.price_level"""

FLAG_LEVELS = ["A", "N", "R"]
STATUS_LEVELS = ["F", "O"]


def q_contingency_flags(spark: SparkSession, sf_dir: str):
    return D.contingency(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus",
                         FLAG_LEVELS, STATUS_LEVELS)


SQL_CONTINGENCY_FLAGS = """
WITH g AS (SELECT * FROM (VALUES ('A'), ('N'), ('R')) a(l_returnflag),
                         (VALUES ('F'), ('O')) b(l_linestatus))
SELECT g.l_returnflag, g.l_linestatus, CAST(count(li.l_orderkey) AS BIGINT) AS n
FROM g LEFT JOIN lineitem li ON li.l_returnflag = g.l_returnflag AND li.l_linestatus = g.l_linestatus
GROUP BY ALL"""


def q_contingency_wide(spark: SparkSession, sf_dir: str):
    w = D.contingency_wide(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", STATUS_LEVELS)
    return w.select("l_returnflag", *[F.col(c).cast("bigint").alias(c) for c in STATUS_LEVELS])


SQL_CONTINGENCY_WIDE = """
SELECT l_returnflag, CAST(sum((l_linestatus = 'F')::INT) AS BIGINT) AS F,
       CAST(sum((l_linestatus = 'O')::INT) AS BIGINT) AS O
FROM lineitem GROUP BY l_returnflag"""


def q_group_means(spark: SparkSession, sf_dir: str):
    return rounded(D.group_means(table(spark, sf_dir, "lineitem"), "l_quantity", "l_returnflag"), 6)


SQL_GROUP_MEANS = "SELECT l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_returnflag"


def q_column_stats(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select(
        "l_quantity", (F.col("l_extendedprice") / 1000).alias("price_k"), "l_discount", "l_tax")
    # means of 2-decimal data terminate within ~7 decimals: 10 is tie-free
    return rounded(D.column_stats(li), 6, {"mean": 10})


SQL_COLUMN_STATS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS column, round(avg({e}), 10) AS mean, round(var_samp({e}), 6) AS var FROM lineitem"
    for n, e in [("l_quantity", "l_quantity"), ("price_k", "l_extendedprice / 1000"),
                 ("l_discount", "l_discount"), ("l_tax", "l_tax")])


def q_profile_by_flag(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_tax")
    return rounded(D.profile_by(li, "l_returnflag"), 10)


SQL_PROFILE_BY_FLAG = """
SELECT l_returnflag, round(avg(l_quantity), 10) AS l_quantity, round(avg(l_discount), 10) AS l_discount,
       round(avg(l_tax), 10) AS l_tax FROM lineitem GROUP BY l_returnflag"""


def q_shape_orders(spark: SparkSession, sf_dir: str):
    return D.shape(table(spark, sf_dir, "orders"))


SQL_SHAPE_ORDERS = "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns FROM orders"


def q_share_by_priority(spark: SparkSession, sf_dir: str):
    c = D.count_non_null_by(table(spark, sf_dir, "orders"), "o_orderpriority")
    return rounded(O.share_of_total(c, "n", "p"), 6)


SQL_SHARE_BY_PRIORITY = """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS p
FROM orders GROUP BY o_orderpriority"""


def q_mid_rank_quantity(spark: SparkSession, sf_dir: str):
    r = O.ranked_values(table(spark, sf_dir, "lineitem"), "l_quantity")
    return rounded(r.select("l_quantity", F.col("n").cast("bigint").alias("n"),
                            F.col("before").cast("bigint").alias("before"), "mid_rank"), 6)


SQL_MID_RANK_QUANTITY = """
WITH c AS (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity),
r AS (SELECT *, sum(n) OVER (ORDER BY l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM c)
SELECT l_quantity, CAST(n AS BIGINT) AS n, CAST(cum - n AS BIGINT) AS before,
       round(CAST(cum - n AS DOUBLE) + (n + 1) / 2.0, 6) AS mid_rank FROM r"""


def q_order_positions_size(spark: SparkSession, sf_dir: str):
    return O.order_positions(table(spark, sf_dir, "part"), "p_size").select(
        "p_size", F.col("i").cast("bigint").alias("i"), F.col("total").cast("bigint").alias("total"))


SQL_ORDER_POSITIONS_SIZE = """
SELECT p_size, CAST(row_number() OVER (ORDER BY p_size) AS BIGINT) AS i,
       CAST(count(*) OVER () AS BIGINT) AS total FROM part"""


def q_head_orders(spark: SparkSession, sf_dir: str):
    """First rows by an explicit key (``head``): a top-k, not a sample."""
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(6)


SQL_HEAD_ORDERS = "SELECT * FROM orders ORDER BY o_orderkey LIMIT 6"


def q_sorted_priority_counts(spark: SparkSession, sf_dir: str):
    return (table(spark, sf_dir, "orders").groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
            .orderBy(F.col("o_orderpriority").asc_nulls_last()))


SQL_SORTED_PRIORITY_COUNTS = """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 ORDER BY 1 NULLS LAST"""


QUERIES = {
    "describe_price": q_describe_price,
    "describe_price_by_priority": q_describe_price_by_priority,
    "describe_quantity_by_flag": q_describe_quantity_by_flag,
    "summary_lineitem": q_summary_lineitem,
    "describe_lineitem": q_describe_lineitem,
    "summary_sketched": q_summary_sketched,
    "missing_total": q_missing_total,
    "missing_share": q_missing_share,
    "missing_patterns": q_missing_patterns,
    "freq_size": q_freq_size,
    "freq_segment_by_nation": q_freq_segment_by_nation,
    "level_counts_price": q_level_counts_price,
    "contingency_flags": q_contingency_flags,
    "contingency_wide": q_contingency_wide,
    "group_means": q_group_means,
    "column_stats": q_column_stats,
    "profile_by_flag": q_profile_by_flag,
    "shape_orders": q_shape_orders,
    "share_by_priority": q_share_by_priority,
    "mid_rank_quantity": q_mid_rank_quantity,
    "order_positions_size": q_order_positions_size,
    "head_orders": q_head_orders,
    "sorted_priority_counts": q_sorted_priority_counts,
}
SQL = {
    "describe_price": SQL_DESCRIBE_PRICE,
    "describe_price_by_priority": SQL_DESCRIBE_PRICE_BY_PRIORITY,
    "describe_quantity_by_flag": SQL_DESCRIBE_QUANTITY_BY_FLAG,
    "summary_lineitem": SQL_SUMMARY_LINEITEM,
    "describe_lineitem": SQL_DESCRIBE_LINEITEM,
    "summary_sketched": SQL_SUMMARY_SKETCHED,
    "missing_total": SQL_MISSING_TOTAL,
    "missing_share": SQL_MISSING_SHARE,
    "missing_patterns": SQL_MISSING_PATTERNS,
    "freq_size": SQL_FREQ_SIZE,
    "freq_segment_by_nation": SQL_FREQ_SEGMENT_BY_NATION,
    "level_counts_price": SQL_LEVEL_COUNTS_PRICE,
    "contingency_flags": SQL_CONTINGENCY_FLAGS,
    "contingency_wide": SQL_CONTINGENCY_WIDE,
    "group_means": SQL_GROUP_MEANS,
    "column_stats": SQL_COLUMN_STATS,
    "profile_by_flag": SQL_PROFILE_BY_FLAG,
    "shape_orders": SQL_SHAPE_ORDERS,
    "share_by_priority": SQL_SHARE_BY_PRIORITY,
    "mid_rank_quantity": SQL_MID_RANK_QUANTITY,
    "order_positions_size": SQL_ORDER_POSITIONS_SIZE,
    "head_orders": SQL_HEAD_ORDERS,
    "sorted_priority_counts": SQL_SORTED_PRIORITY_COUNTS,
}

"""Scalar, string, array, duration, recode and binning operators bound to
the driver tables (``part``, ``lineitem``, ``events``, ``orders``,
``customer``)."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tabkit.functions import columns as X
from tabkit.operators import frame
from tabkit.plans.tables import table


def q_scalar_ops(spark: SparkSession, sf_dir: str):
    p = table(spark, sf_dir, "part")
    s, price = F.col("p_size"), F.col("p_retailprice")
    return p.select(
        "p_partkey",
        (s * 3 - 2 + 4 * 10).alias("arith"),
        X.true_div(s, 2).alias("div_half"),
        F.round(X.true_div(s, s - 25), 6).alias("div_or_null"),
        X.py_mod(s - 25, 7).alias("mod_pos_divisor"),
        X.py_mod(s, -7).alias("mod_neg_divisor"),
        X.int_power(s, 2).alias("size_sq"),
        F.round(F.sqrt(price), 6).alias("sqrt_price"),
        F.round(F.ln(price), 6).alias("ln_price"),
        F.round(F.log10(price), 6).alias("log10_price"),
        F.round(F.exp(s / 10.0), 6).alias("exp_size"),
        X.round_half_even(price / 7, 2).alias("bround_price"),
    )


SQL_SCALAR = """
SELECT p_partkey,
       p_size * 3 - 2 + 4 * 10 AS arith,
       CAST(p_size AS DOUBLE) / 2 AS div_half,
       CASE WHEN p_size = 25 THEN NULL ELSE round(CAST(p_size AS DOUBLE) / (p_size - 25), 6) END AS div_or_null,
       ((p_size - 25) % 7 + 7) % 7 AS mod_pos_divisor,
       -((((-p_size) % 7) + 7) % 7) AS mod_neg_divisor,
       CAST(power(p_size, 2) AS BIGINT) AS size_sq,
       round(sqrt(p_retailprice), 6) AS sqrt_price,
       round(ln(p_retailprice), 6) AS ln_price,
       round(log10(p_retailprice), 6) AS log10_price,
       round(exp(CAST(p_size AS DOUBLE) / 10), 6) AS exp_size,
       round_even(p_retailprice / 7, 2) AS bround_price
FROM part"""


def q_string_ops(spark: SparkSession, sf_dir: str):
    p = table(spark, sf_dir, "part")
    n = F.col("p_name")
    return p.select(
        "p_partkey",
        F.concat("p_brand", F.lit(" "), "p_type").alias("brand_type"),
        F.concat(F.repeat(F.lit("-"), 3), F.col("p_brand")).alias("ruled_brand"),
        X.char_at(n, 3).alias("ch3"),
        X.char_at(n, -1).alias("ch_last"),
        X.char_at(n, 99).alias("ch99"),
        X.str_slice(n, 0, 2).alias("head2"),
        X.str_slice(n, None, 99).alias("head99"),
        X.str_slice(n, -2, None).alias("tail2"),
        X.replace_first_char(n, "N").alias("renamed"),
        F.length(n).cast("bigint").alias("name_len"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("trimmed"),
    )


SQL_STRING = """
SELECT p_partkey,
       p_brand || ' ' || p_type AS brand_type,
       repeat('-', 3) || p_brand AS ruled_brand,
       CASE WHEN length(p_name) > 3 THEN substring(p_name, 4, 1) END AS ch3,
       CASE WHEN length(p_name) >= 1 THEN substring(p_name, length(p_name), 1) END AS ch_last,
       CASE WHEN length(p_name) > 99 THEN substring(p_name, 100, 1) END AS ch99,
       substring(p_name, 1, 2) AS head2,
       substring(p_name, 1, 99) AS head99,
       CASE WHEN length(p_name) >= 2 THEN substring(p_name, length(p_name) - 1, 2) ELSE p_name END AS tail2,
       'N' || substring(p_name, 2) AS renamed,
       CAST(length(p_name) AS BIGINT) AS name_len,
       trim('  ' || p_type || ' ') AS trimmed
FROM part"""


def q_array_ops(spark: SparkSession, sf_dir: str):
    p = table(spark, sf_dir, "part")
    w = F.split(F.col("p_name"), " ")
    nested = F.array(w, F.split(F.col("p_type"), " "))
    j = lambda a: F.array_join(a, "|")
    return p.select(
        "p_partkey",
        X.arr_get(w, 0).alias("w_first"),
        X.arr_get(w, -1).alias("w_last"),
        X.arr_get(w, 5).alias("w_oob"),
        j(X.arr_slice(w, -2, None)).alias("w_last2"),
        j(X.arr_slice(w, None, 3)).alias("w_first3"),
        j(F.concat(w, F.array(F.lit("x"), F.lit("y")))).alias("w_plus"),
        j(X.arr_set(w, 1, F.lit("Z"))).alias("w_set1"),
        j(X.arr_append(w, F.lit("end"))).alias("w_appended"),
        j(X.arr_replace_slice(w, 0, 1, F.array(F.lit("A"), F.lit("B")))).alias("w_replaced"),
        j(X.arr_replace_slice(w, 0, 1, F.array().cast("array<string>"))).alias("w_deleted"),
        F.size(w).cast("bigint").alias("n_words"),
        X.arr_get(X.arr_get(nested, 0), 0).alias("nested_first"),
        X.arr_get(X.arr_get(nested, -1), -1).alias("nested_last"),
    )


SQL_ARRAY = """
WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w, string_split(p_type, ' ') AS v FROM part)
SELECT p_partkey,
       w[1] AS w_first,
       w[-1] AS w_last,
       CASE WHEN len(w) > 5 THEN w[6] END AS w_oob,
       array_to_string(list_slice(w, -2, -1), '|') AS w_last2,
       array_to_string(w[1:3], '|') AS w_first3,
       array_to_string(list_concat(w, ['x', 'y']), '|') AS w_plus,
       array_to_string(list_transform(w, lambda x, i: CASE WHEN i = 2 THEN 'Z' ELSE x END), '|') AS w_set1,
       array_to_string(list_append(w, 'end'), '|') AS w_appended,
       array_to_string(list_concat(['A', 'B'], w[2:]), '|') AS w_replaced,
       array_to_string(w[2:], '|') AS w_deleted,
       CAST(len(w) AS BIGINT) AS n_words,
       w[1] AS nested_first,
       v[-1] AS nested_last
FROM t"""


def q_duration_text(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    secs = F.col("l_quantity").cast("bigint") * 2000 + F.col("l_linenumber")
    return li.select("l_orderkey", "l_linenumber", secs.alias("seconds"),
                     X.seconds_to_hms(secs).alias("duration_text"))


SQL_DURATION = """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * 2000 + l_linenumber AS s FROM lineitem),
u AS (SELECT *, CAST(floor(s / 86400) AS BIGINT) AS d FROM t),
v AS (SELECT *, s - d * 86400 AS r FROM u)
SELECT l_orderkey, l_linenumber, s AS seconds,
       CASE WHEN d = 0 THEN lpad(CAST(r // 3600 AS VARCHAR) || ':' || lpad(CAST((r % 3600) // 60 AS VARCHAR), 2, '0')
                                 || ':' || lpad(CAST(r % 60 AS VARCHAR), 2, '0'), 8, '0')
            ELSE CAST(d AS VARCHAR) || CASE WHEN abs(d) = 1 THEN ' day, ' ELSE ' days, ' END
                 || CAST(r // 3600 AS VARCHAR) || ':' || lpad(CAST((r % 3600) // 60 AS VARCHAR), 2, '0')
                 || ':' || lpad(CAST(r % 60 AS VARCHAR), 2, '0') END AS duration_text
FROM v"""


# events.event_type -> the slope text of the fuel exercise (purchase has none)
_SLOPE_TEXT = {"click": "+10%", "view": "+6%", "error": "-10%", "signup": "-6%"}


def _events_with_slope(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    kv = []
    for k, v in _SLOPE_TEXT.items():
        kv += [F.lit(k), F.lit(v)]
    return ev.withColumn("slope", F.try_element_at(F.create_map(*kv), F.col("event_type")))


_SLOPE_SQL = ("CASE event_type WHEN 'click' THEN '+10%' WHEN 'view' THEN '+6%' "
              "WHEN 'error' THEN '-10%' WHEN 'signup' THEN '-6%' END")


def q_recode_slope(spark: SparkSession, sf_dir: str):
    ev = _events_with_slope(spark, sf_dir)
    return ev.select("event_id", "slope",
                     X.recode("slope", X.SLOPE_RECODE, 0.0).alias("slope_value"))


SQL_RECODE = f"""
WITH t AS (SELECT event_id, {_SLOPE_SQL} AS slope FROM events)
SELECT event_id, slope,
       CASE slope WHEN '+10%' THEN 0.1 WHEN '+6%' THEN 0.06 WHEN '-10%' THEN -0.1
                  WHEN '-6%' THEN -0.06 ELSE 0.0 END::DOUBLE AS slope_value
FROM t"""


def q_count_by_slope(spark: SparkSession, sf_dir: str):
    from tabkit.operators import describe
    return describe.count_non_null_by(_events_with_slope(spark, sf_dir), "slope")


SQL_COUNT_BY_SLOPE = f"""
SELECT slope, CAST(count(*) AS BIGINT) AS n FROM (SELECT {_SLOPE_SQL} AS slope FROM events)
WHERE slope IS NOT NULL GROUP BY slope"""

# Breaks scaled to o_totalprice (1e3..5e5); right-closed, outside -> NULL.
PRICE_BREAKS = [10000.0, 81000.0, 162000.0, 400000.0]
PRICE_LABELS = ["bajo", "medio", "alto"]


def q_cut_price(spark: SparkSession, sf_dir: str):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_totalprice",
                    X.cut("o_totalprice", PRICE_BREAKS, PRICE_LABELS).alias("price_level"),
                    X.cut_level("o_totalprice", PRICE_BREAKS).alias("price_level_no"))


SQL_CUT_PRICE = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_totalprice > 10000 AND o_totalprice <= 81000 THEN 'bajo'
            WHEN o_totalprice > 81000 AND o_totalprice <= 162000 THEN 'medio'
            WHEN o_totalprice > 162000 AND o_totalprice <= 400000 THEN 'alto' END AS price_level,
       CASE WHEN o_totalprice > 10000 AND o_totalprice <= 81000 THEN 1
            WHEN o_totalprice > 81000 AND o_totalprice <= 162000 THEN 2
            WHEN o_totalprice > 162000 AND o_totalprice <= 400000 THEN 3 END AS price_level_no
FROM orders"""


def q_cut_sd_price(spark: SparkSession, sf_dir: str):
    o = table(spark, sf_dir, "orders")
    return frame.cut_by_sd(o, "o_totalprice", 0.7, ["Bajo", "Medio", "Alto"], "price_sd_level") \
        .select("o_orderkey", "price_sd_level")


SQL_CUT_SD_PRICE = """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS m,
                  stddev_samp(o_totalprice) AS sd FROM orders)
SELECT o_orderkey,
       CASE WHEN o_totalprice > lo - 1 AND o_totalprice <= m - 0.7 * sd THEN 'Bajo'
            WHEN o_totalprice > m - 0.7 * sd AND o_totalprice <= m + 0.7 * sd THEN 'Medio'
            WHEN o_totalprice > m + 0.7 * sd AND o_totalprice <= hi + 1 THEN 'Alto' END AS price_sd_level
FROM orders, s"""


def q_derived_ratios(spark: SparkSession, sf_dir: str):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.round(F.sqrt("l_extendedprice"), 6).alias("sqrt_price"),
        F.round(X.ratio_log10_sq("l_extendedprice", "l_quantity"), 6).alias("log10_ratio_sq"),
        F.round(X.ratio_sqrt("l_extendedprice", "l_quantity"), 6).alias("sqrt_ratio"),
        F.round(X.ratio_sqrt("l_extendedprice", F.col("l_discount")), 6).alias("sqrt_ratio_zero_div"),
    )


SQL_DERIVED = """
SELECT l_orderkey, l_linenumber,
       round(sqrt(l_extendedprice), 6) AS sqrt_price,
       round(CASE WHEN l_quantity <> 0 AND l_extendedprice / l_quantity > 0
                  THEN power(log10(l_extendedprice / l_quantity), 2) END, 6) AS log10_ratio_sq,
       round(CASE WHEN l_quantity <> 0 AND l_extendedprice / l_quantity >= 0
                  THEN sqrt(l_extendedprice / l_quantity) END, 6) AS sqrt_ratio,
       round(CASE WHEN l_discount <> 0 AND l_extendedprice / l_discount >= 0
                  THEN sqrt(l_extendedprice / l_discount) END, 6) AS sqrt_ratio_zero_div
FROM lineitem"""


def _customer_with_gaps(spark, sf_dir):
    """customer with NULLs made by ``nullif`` (the tables have none)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("balance"),
    )


_CUSTOMER_GAPS_SQL = """(SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
       nullif(c_nationkey, 0) AS nation,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance FROM customer)"""


def q_coerce_numeric(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "customer")
    text = c.select(
        "c_custkey",
        F.col("c_acctbal").cast("string").alias("acctbal_text"),
        F.col("c_mktsegment").alias("segment_text"),
        F.col("c_nationkey").cast("string").alias("nation_text"))
    out = frame.coerce_numeric(frame.drop_first_column(text))
    return out.select(F.round("acctbal_text", 2).alias("acctbal"),
                      F.col("segment_text").alias("segment"),
                      F.col("nation_text").alias("nation"))


SQL_COERCE = """
SELECT round(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE), 2) AS acctbal,
       TRY_CAST(c_mktsegment AS DOUBLE) AS segment,
       TRY_CAST(CAST(c_nationkey AS VARCHAR) AS DOUBLE) AS nation
FROM customer"""


def q_drop_incomplete(spark: SparkSession, sf_dir: str):
    return _customer_with_gaps(spark, sf_dir).na.drop("any")


SQL_DROP_INCOMPLETE = f"""
SELECT * FROM {_CUSTOMER_GAPS_SQL} t
WHERE segment IS NOT NULL AND nation IS NOT NULL AND balance IS NOT NULL"""


def q_null_flags(spark: SparkSession, sf_dir: str):
    c = _customer_with_gaps(spark, sf_dir)
    return c.select("c_custkey", F.col("segment").isNull().alias("segment_is_null"),
                    F.col("balance").isNull().alias("balance_is_null"))


SQL_NULL_FLAGS = f"""
SELECT c_custkey, segment IS NULL AS segment_is_null, balance IS NULL AS balance_is_null
FROM {_CUSTOMER_GAPS_SQL} t"""


def q_service_filter(spark: SparkSession, sf_dir: str):
    """Disjunctive filter on a trimmed code (two accepted values)."""
    li = table(spark, sf_dir, "lineitem")
    code = F.trim(F.concat(F.lit(" "), F.col("l_returnflag")))
    return li.where(code.isin("A", "R")).select("l_orderkey", "l_linenumber", "l_returnflag")


SQL_SERVICE_FILTER = """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
WHERE trim(' ' || l_returnflag) = 'A' OR trim(' ' || l_returnflag) = 'R'"""


QUERIES = {
    "scalar_ops": q_scalar_ops,
    "string_ops": q_string_ops,
    "array_ops": q_array_ops,
    "duration_text": q_duration_text,
    "recode_slope": q_recode_slope,
    "count_by_slope": q_count_by_slope,
    "cut_price": q_cut_price,
    "cut_sd_price": q_cut_sd_price,
    "derived_ratios": q_derived_ratios,
    "coerce_numeric": q_coerce_numeric,
    "drop_incomplete": q_drop_incomplete,
    "null_flags": q_null_flags,
    "service_filter": q_service_filter,
}
SQL = {
    "scalar_ops": SQL_SCALAR,
    "string_ops": SQL_STRING,
    "array_ops": SQL_ARRAY,
    "duration_text": SQL_DURATION,
    "recode_slope": SQL_RECODE,
    "count_by_slope": SQL_COUNT_BY_SLOPE,
    "cut_price": SQL_CUT_PRICE,
    "cut_sd_price": SQL_CUT_SD_PRICE,
    "derived_ratios": SQL_DERIVED,
    "coerce_numeric": SQL_COERCE,
    "drop_incomplete": SQL_DROP_INCOMPLETE,
    "null_flags": SQL_NULL_FLAGS,
    "service_filter": SQL_SERVICE_FILTER,
}

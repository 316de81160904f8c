"""Sources, sinks and the landing-zone ingest bound to the driver tables.

Staged copies (CSV day folders, ORC, text, landing files) are written by
Spark from the driver tables into a fresh folder below the session's
checkpoint directory (the cluster's shared folder) and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession, functions as F
from pyspark.sql import types as T

from tabkit.functions import columns as X
from tabkit.operators import claims as C
from tabkit.plans import bind_claims as BC
from tabkit.plans.tables import table
from tabkit.session import checkpoint_dir
from tabkit.sinks.files import write_delimited
from tabkit.sources import daywindow as W
from tabkit.sources.delimited import (SourceSpec, all_text_schema, read_comma_no_header,
                                      read_lines, read_orc, read_pipe_with_header)
from tabkit.streaming.files import file_states, ingest_files
from tabkit.streaming.landing import ingest_available, read_output

ASOF = dt.date(2000, 6, 15)
MONTHS = 3


def staging(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabkit-staging/{name}-{uuid.uuid4().hex}"


def q_day_window_orders(spark: SparkSession, sf_dir: str):
    o = table(spark, sf_dir, "orders")
    return o.where(W.in_window("o_orderdate", ASOF, MONTHS)).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_comunicacion"))


SQL_DAY_WINDOW_ORDERS = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS fecha_comunicacion FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-03-15' AND DATE '2000-06-15'"""

FIXED_SCHEMA = all_text_schema(C.FIXED_CALL_COLUMNS + ["fecha_comunicacion"])


def stage_fixed_calls(spark: SparkSession, sf_dir: str) -> str:
    """Fixed-line records as header-less ``|`` CSV, one folder per day."""
    path = staging(spark, "fixed-calls")
    raw = BC.fixed_raw_from_lineitem(spark, sf_dir).withColumn(
        "fecha_comunicacion", F.col("EVENT_INIT_DATE"))
    (raw.repartition("fecha_comunicacion").write.mode("overwrite").partitionBy("fecha_comunicacion")
     .option("sep", "|").option("header", "false").csv(path))
    return path


def q_claims_detail_fixed_window(spark: SparkSession, sf_dir: str):
    """The fixed-line job end to end: day-window scan of the staged day
    folders (partition pruning), direction swap, two-key match, catalogue."""
    path = stage_fixed_calls(spark, sf_dir)
    raw = W.read_hive_window(spark, path, SourceSpec("csv", "|", False, FIXED_SCHEMA),
                             "fecha_comunicacion", ASOF, MONTHS)
    calls = C.fixed_calls(raw, BC.INCOMING)
    return C.claims_detail(BC.claims_from_supplier(spark, sf_dir), calls,
                           BC.catalogue_from_nation(spark, sf_dir))


SQL_CLAIMS_DETAIL_FIXED_WINDOW = BC.SQL_FIXED.replace(
    "  FROM lineitem),",
    "  FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2000-03-15' AND DATE '2000-06-15'),", 1)

MOBILE_SCHEMA = all_text_schema(C.MOBILE_CALL_COLUMNS)
# window that runs past the last shipping day: the tail days are missing
NAMED_ASOF = dt.date(2001, 11, 14)


def stage_mobile_calls(spark: SparkSession, sf_dir: str) -> str:
    """Mobile records as header-less ``|`` CSV below ``day=YYYYMMDD``."""
    path = staging(spark, "mobile-calls")
    raw = BC.mobile_raw_from_lineitem(spark, sf_dir).withColumn("day", F.col("FecIni"))
    (raw.repartition("day").write.mode("overwrite").partitionBy("day")
     .option("sep", "|").option("header", "false").csv(path))
    return path


def _named_read(spark, sf_dir):
    path = stage_mobile_calls(spark, sf_dir)
    return W.read_named_days(spark, lambda d: f"{path}/day={d:%Y%m%d}/*.csv",
                             SourceSpec("csv", "|", False, MOBILE_SCHEMA), NAMED_ASOF, MONTHS,
                             day_column="file_day", day_regex=r"day=(\d{8})")


def q_named_days_calls(spark: SparkSession, sf_dir: str):
    df, _ = _named_read(spark, sf_dir)
    return df.select("file_day", *C.MOBILE_CALL_COLUMNS)


SQL_NAMED_DAYS_CALLS = """
SELECT strftime(l_shipdate, '%Y%m%d') AS file_day, strftime(l_shipdate, '%Y%m%d') AS FecIni,
       CAST(l_linenumber AS VARCHAR) || '0000' AS HoraIni, l_linestatus AS CodSentTraf,
       CAST(CAST(l_quantity AS BIGINT) * 60 AS VARCHAR) AS DurReal,
       lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS NumOri, CAST(l_suppkey AS VARCHAR) AS NumDest,
       CAST(l_linenumber AS VARCHAR) AS CodOper,
       CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS CodEstValor, l_returnflag AS CodTipServTraf
FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-08-14' AND DATE '2001-11-14'"""


def q_named_days_missing(spark: SparkSession, sf_dir: str):
    _, skipped = _named_read(spark, sf_dir)
    return skipped.select("day")


SQL_NAMED_DAYS_MISSING = """
SELECT CAST(d AS DATE) AS day FROM generate_series(DATE '2001-08-14', DATE '2001-11-14', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT DISTINCT CAST(l_shipdate AS DATE) FROM lineitem)"""

PART_SCHEMA = ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
               "p_retailprice double")


def q_delimited_roundtrip(spark: SparkSession, sf_dir: str):
    path = staging(spark, "part-pipe")
    write_delimited(table(spark, sf_dir, "part"), path, sep="|", header=True)
    return read_pipe_with_header(spark, path, PART_SCHEMA)


SQL_DELIMITED_ROUNDTRIP = "SELECT * FROM part"


def q_comma_roundtrip(spark: SparkSession, sf_dir: str):
    path = staging(spark, "part-comma")
    write_delimited(table(spark, sf_dir, "part"), path, sep=",", header=False, files=2)
    return read_comma_no_header(spark, path, PART_SCHEMA)


def q_orc_roundtrip(spark: SparkSession, sf_dir: str):
    path = staging(spark, "orders-orc")
    table(spark, sf_dir, "orders").write.mode("overwrite").orc(path)
    return read_orc(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderpriority")


SQL_ORC_ROUNDTRIP = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def q_line_scan(spark: SparkSession, sf_dir: str):
    path = staging(spark, "part-lines")
    table(spark, sf_dir, "part").select(F.concat_ws(" | ", "p_name", "p_type").alias("value")) \
        .write.mode("overwrite").text(path)
    return read_lines(spark, path).select("value")


SQL_LINE_SCAN = "SELECT p_name || ' | ' || p_type AS value FROM part"


def q_single_column_export(spark: SparkSession, sf_dir: str):
    """Recode then export one column as ``|`` CSV with header; read back."""
    from tabkit.plans.bind_columns import _events_with_slope
    ev = _events_with_slope(spark, sf_dir).select(X.recode("slope", X.SLOPE_RECODE).alias("slope_value"))
    path = staging(spark, "slope-export")
    write_delimited(ev, path, sep="|", header=True)
    return read_pipe_with_header(spark, path, "slope_value double")


SQL_SINGLE_COLUMN_EXPORT = """
SELECT CASE event_type WHEN 'click' THEN 0.1 WHEN 'view' THEN 0.06 WHEN 'error' THEN -0.1
                       WHEN 'signup' THEN -0.06 ELSE 0.0 END::DOUBLE AS slope_value FROM events"""

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("slope", T.StringType())])


def _land_events(spark, sf_dir):
    """Write the events as landing CSV files; error events carry an
    unparsable value so they end up in the quarantine."""
    from tabkit.plans.bind_columns import _events_with_slope
    root = staging(spark, "landing")
    ev = _events_with_slope(spark, sf_dir).select(
        "event_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        "slope")
    ev.write.option("header", "true").csv(f"{root}/input")
    ingest_available(spark, f"{root}/input", EVENT_SCHEMA, f"{root}/processed", f"{root}/invalid",
                     f"{root}/_checkpoint", archive_dir=f"{root}/archive",
                     transform=lambda d: d.withColumn("slope_value", X.recode("slope", X.SLOPE_RECODE)))
    return root


def q_landing_ingest(spark: SparkSession, sf_dir: str):
    root = _land_events(spark, sf_dir)
    return read_output(spark, f"{root}/processed").select("event_id", "event_type", "value", "slope_value")


SQL_LANDING_INGEST = """
SELECT event_id, event_type, value,
       CASE event_type WHEN 'click' THEN 0.1 WHEN 'view' THEN 0.06 WHEN 'signup' THEN -0.06 ELSE 0.0 END::DOUBLE
         AS slope_value
FROM events WHERE event_type <> 'error'"""


def q_landing_quarantine(spark: SparkSession, sf_dir: str):
    root = _land_events(spark, sf_dir)
    return read_output(spark, f"{root}/invalid").select(
        F.split("raw", ",")[0].cast("bigint").alias("event_id"))


SQL_LANDING_QUARANTINE = "SELECT event_id FROM events WHERE event_type = 'error'"


def q_file_ingest(spark: SparkSession, sf_dir: str):
    """Events landed as CSV files by type, those of errors unparsable: state
    and rows of the files by the manifest, and rows of the output."""
    root = staging(spark, "files")
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("event_type").alias("kind"),
                                               F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"))
    ev.write.option("header", "true").partitionBy("kind").csv(f"{root}/input")
    ingest_files(spark, f"{root}/input", T.StructType([EVENT_SCHEMA[c] for c in ("event_id", "event_type", "value")]),
                 f"{root}/out", f"{root}/invalid", f"{root}/archive", f"{root}/manifest")
    kind = lambda c: F.regexp_extract(c, "^kind=([^/]*)/", 1).alias("kind")
    out = spark.read.parquet(f"{root}/out").groupBy(kind("_source_file")).agg(F.count(F.lit(1)).alias("n_output"), F.round(F.sum("value"), 2).alias("value"))
    states = file_states(spark, f"{root}/manifest").groupBy(kind("name"), "state").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))
    return states.join(out, "kind", "left").select("kind", "state", "n_rows", "n_bad", F.coalesce("n_output", F.lit(0)).alias("n_output"), "value")


SQL_FILE_INGEST = """
SELECT event_type AS kind, CASE event_type WHEN 'error' THEN 'quarantined' ELSE 'archived' END AS state,
       count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_bad, count(*) FILTER (event_type <> 'error') AS n_output,
       round(sum(value) FILTER (event_type <> 'error'), 2) AS value
FROM events GROUP BY 1, 2"""


QUERIES = {
    "day_window_orders": q_day_window_orders,
    "claims_detail_fixed_window": q_claims_detail_fixed_window,
    "named_days_calls": q_named_days_calls,
    "named_days_missing": q_named_days_missing,
    "delimited_roundtrip": q_delimited_roundtrip,
    "comma_roundtrip": q_comma_roundtrip,
    "orc_roundtrip": q_orc_roundtrip,
    "line_scan": q_line_scan,
    "single_column_export": q_single_column_export,
    "landing_ingest": q_landing_ingest,
    "landing_quarantine": q_landing_quarantine,
    "file_ingest": q_file_ingest,
}
SQL = {
    "day_window_orders": SQL_DAY_WINDOW_ORDERS,
    "claims_detail_fixed_window": SQL_CLAIMS_DETAIL_FIXED_WINDOW,
    "named_days_calls": SQL_NAMED_DAYS_CALLS,
    "named_days_missing": SQL_NAMED_DAYS_MISSING,
    "delimited_roundtrip": SQL_DELIMITED_ROUNDTRIP,
    "comma_roundtrip": SQL_DELIMITED_ROUNDTRIP,
    "orc_roundtrip": SQL_ORC_ROUNDTRIP,
    "line_scan": SQL_LINE_SCAN,
    "single_column_export": SQL_SINGLE_COLUMN_EXPORT,
    "landing_ingest": SQL_LANDING_INGEST,
    "landing_quarantine": SQL_LANDING_QUARANTINE,
    "file_ingest": SQL_FILE_INGEST,
}

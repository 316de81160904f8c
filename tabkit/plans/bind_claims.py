"""Claims matching bound to the driver tables.

claims    <- supplier (subscription number = s_suppkey)
calls     <- lineitem (origin = l_partkey, destination = l_suppkey,
             direction = l_returnflag with 'R' playing the incoming 'E',
             service type = l_returnflag, operator code = l_linenumber)
catalogue <- nation keys 1..5, key 3 without description, key 5 twice
Numbers carry blanks and leading zeros so trimming and key normalisation
are exercised on every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabkit.operators import claims as C
from tabkit.plans.tables import table

SERVICE_TYPES = ("A", "R")   # plays the role of the source's ("S", "V")
INCOMING = "R"               # plays the role of the source's "E"


def claims_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    return s.select(
        F.concat(F.lit("RC"), k).alias("ID_CORRELATIVO_RECLAMO"),
        F.col("s_name").alias("CLIENTE"),
        k.alias("SUSCRIPCION"),
        F.col("s_nationkey").cast("string").alias("CICLO"),
        F.concat(F.lit("CF"), F.lpad(k, 8, "0")).alias("CUENTA_FINANCIERA"),
        F.concat(F.lit("C"), k).alias("CODIGO_CLIENTE"),
        k.alias("ID_SUSCRIPCION"),
        F.lit("RUC").alias("TIPO_DOCUMENTO_CLIENTE"),
        F.lpad(k, 11, "0").alias("NUMERO_DOCUMENTO_CLIENTE"),
        F.lit("EMPRESAS").alias("SEGMENTO"),
    )


def catalogue_from_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    base = n.where(F.col("n_nationkey").between(1, 5)).select(
        F.col("n_nationkey").cast("string").alias("CODE_OPER"),
        F.when(F.col("n_nationkey") == 3, F.lit(None).cast("string"))
        .otherwise(F.col("n_name")).alias("DESCRIPTION"))
    dup = n.where(F.col("n_nationkey") == 5).select(
        F.col("n_nationkey").cast("string").alias("CODE_OPER"),
        F.concat(F.col("n_name"), F.lit("_ALT")).alias("DESCRIPTION"))
    return base.unionByName(dup)


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint").cast("string")


def mobile_raw_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("FecIni"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("0000 ")).alias("HoraIni"),
        F.col("l_linestatus").alias("CodSentTraf"),
        (F.col("l_quantity").cast("bigint") * 60).cast("string").alias("DurReal"),
        F.concat(F.lit(" "), F.lpad(F.col("l_partkey").cast("string"), 6, "0")).alias("NumOri"),
        F.col("l_suppkey").cast("string").alias("NumDest"),
        F.col("l_linenumber").cast("string").alias("CodOper"),
        _cents("l_extendedprice").alias("CodEstValor"),
        F.concat(F.col("l_returnflag"), F.lit(" ")).alias("CodTipServTraf"),
    )


def fixed_raw_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("EVENT_INIT_DATE"),
        F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(":00:00")).alias("EVENT_INIT_TIME"),
        F.col("l_returnflag").alias("EVENT_DIRECTION"),
        (F.col("l_quantity").cast("bigint") * 60).cast("string").alias("REAL_DURATION"),
        F.col("l_suppkey").cast("string").alias("TARGET_NUMBER"),
        F.col("l_partkey").cast("string").alias("ORIGIN_NUMBER"),
        F.col("l_linenumber").cast("string").alias("OPERATOR_CODE"),
        _cents("l_extendedprice").alias("REAL_COST"),
        F.col("l_linestatus").alias("BILL_ST_USER"),
    )


def q_claims_detail_mobile(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = C.mobile_calls(mobile_raw_from_lineitem(spark, sf_dir), SERVICE_TYPES)
    return C.claims_detail(claims_from_supplier(spark, sf_dir), calls,
                           catalogue_from_nation(spark, sf_dir))


def q_claims_detail_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = C.fixed_calls(fixed_raw_from_lineitem(spark, sf_dir), INCOMING)
    return C.claims_detail(claims_from_supplier(spark, sf_dir), calls,
                           catalogue_from_nation(spark, sf_dir))


def q_claims_detail_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same result as the mobile query through the shuffle path: claims are
    never broadcast and every number with >= 100 calls is salted."""
    calls = C.mobile_calls(mobile_raw_from_lineitem(spark, sf_dir), SERVICE_TYPES)
    return C.claims_detail(claims_from_supplier(spark, sf_dir), calls,
                           catalogue_from_nation(spark, sf_dir),
                           broadcast_claims_rows=0, hot_rows=100, salt_buckets=8)


# ---- DuckDB oracle ---------------------------------------------------------

def _key(x: str) -> str:
    return f"coalesce(CAST(TRY_CAST(trim({x}) AS BIGINT) AS VARCHAR), trim({x}))"


_CLAIMS_SQL = """
claims AS (
  SELECT 'RC' || CAST(s_suppkey AS VARCHAR) AS ID_CORRELATIVO_RECLAMO,
         s_name AS CLIENTE,
         CAST(s_suppkey AS VARCHAR) AS SUSCRIPCION,
         CAST(s_nationkey AS VARCHAR) AS CICLO,
         'CF' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS CUENTA_FINANCIERA,
         'C' || CAST(s_suppkey AS VARCHAR) AS CODIGO_CLIENTE,
         CAST(s_suppkey AS VARCHAR) AS ID_SUSCRIPCION,
         'RUC' AS TIPO_DOCUMENTO_CLIENTE,
         lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS NUMERO_DOCUMENTO_CLIENTE,
         'EMPRESAS' AS SEGMENTO
  FROM supplier),
cat AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS CODE_OPER,
         CASE WHEN n_nationkey = 3 THEN NULL ELSE n_name END AS DESCRIPTION
  FROM nation WHERE n_nationkey BETWEEN 1 AND 5
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), n_name || '_ALT' FROM nation WHERE n_nationkey = 5)"""

_DETAIL_SELECT = f"""
SELECT 'NIFI' AS TEMPLATEID, R.ID_CORRELATIVO_RECLAMO, R.CLIENTE, R.SUSCRIPCION, R.CICLO,
       R.CUENTA_FINANCIERA, T.FECHA_INICIO_LLAMADA, T.HORA_INICIO_LLAMADA, T.TIPO_LLAMADA,
       T.DURACION_LLAMADA, T.TIPO_EVENTO, T.SUBTIPO_EVENTO, T.NUMERO_DESTINO,
       CASE WHEN C.CODE_OPER IS NULL THEN T.CODE_OPER ELSE C.DESCRIPTION END AS DESCRIPCION_OPERADORA,
       T.VALOR, T.TIPO_TRAFICO, R.CODIGO_CLIENTE, R.ID_SUSCRIPCION, R.TIPO_DOCUMENTO_CLIENTE,
       R.NUMERO_DOCUMENTO_CLIENTE, R.SEGMENTO
FROM claims R
JOIN calls T ON ({_key('R.SUSCRIPCION')} = {_key('T.NUMERO_ORIGEN')}
             OR {_key('R.SUSCRIPCION')} = {_key('T.NUMERO_DESTINO')})
LEFT JOIN cat C ON {_key('T.CODE_OPER')} = {_key('C.CODE_OPER')}
"""

SQL_MOBILE = f"""
WITH {_CLAIMS_SQL},
raw AS (
  SELECT strftime(l_shipdate, '%Y%m%d') AS FecIni,
         CAST(l_linenumber AS VARCHAR) || '0000 ' AS HoraIni,
         l_linestatus AS CodSentTraf,
         CAST(CAST(l_quantity AS BIGINT) * 60 AS VARCHAR) AS DurReal,
         ' ' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS NumOri,
         CAST(l_suppkey AS VARCHAR) AS NumDest,
         CAST(l_linenumber AS VARCHAR) AS CodOper,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS CodEstValor,
         l_returnflag || ' ' AS CodTipServTraf
  FROM lineitem),
calls AS (
  SELECT trim(FecIni) AS FECHA_INICIO_LLAMADA, trim(HoraIni) AS HORA_INICIO_LLAMADA,
         trim(CodSentTraf) AS TIPO_LLAMADA, trim(DurReal) AS DURACION_LLAMADA,
         'TASADO' AS TIPO_EVENTO, 'TASADO' AS SUBTIPO_EVENTO,
         trim(NumOri) AS NUMERO_ORIGEN, trim(NumDest) AS NUMERO_DESTINO,
         trim(CodOper) AS CODE_OPER, trim(CodEstValor) AS VALOR,
         trim(CodTipServTraf) AS TIPO_TRAFICO
  FROM raw WHERE trim(CodTipServTraf) = 'A' OR trim(CodTipServTraf) = 'R')
{_DETAIL_SELECT}"""

SQL_FIXED = f"""
WITH {_CLAIMS_SQL},
raw AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS EVENT_INIT_DATE,
         lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS EVENT_INIT_TIME,
         l_returnflag AS EVENT_DIRECTION,
         CAST(CAST(l_quantity AS BIGINT) * 60 AS VARCHAR) AS REAL_DURATION,
         CAST(l_suppkey AS VARCHAR) AS TARGET_NUMBER,
         CAST(l_partkey AS VARCHAR) AS ORIGIN_NUMBER,
         CAST(l_linenumber AS VARCHAR) AS OPERATOR_CODE,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS REAL_COST,
         l_linestatus AS BILL_ST_USER
  FROM lineitem),
calls AS (
  SELECT EVENT_INIT_DATE AS FECHA_INICIO_LLAMADA, EVENT_INIT_TIME AS HORA_INICIO_LLAMADA,
         EVENT_DIRECTION AS TIPO_LLAMADA, REAL_DURATION AS DURACION_LLAMADA,
         'TASADO' AS TIPO_EVENTO, 'TASADO' AS SUBTIPO_EVENTO,
         CASE WHEN EVENT_DIRECTION = 'R' THEN TARGET_NUMBER ELSE ORIGIN_NUMBER END AS NUMERO_ORIGEN,
         CASE WHEN EVENT_DIRECTION = 'R' THEN ORIGIN_NUMBER ELSE TARGET_NUMBER END AS NUMERO_DESTINO,
         OPERATOR_CODE AS CODE_OPER, REAL_COST AS VALOR, BILL_ST_USER AS TIPO_TRAFICO
  FROM raw)
{_DETAIL_SELECT}"""

QUERIES = {
    "claims_detail_mobile": q_claims_detail_mobile,
    "claims_detail_fixed": q_claims_detail_fixed,
    "claims_detail_salted": q_claims_detail_salted,
}
SQL = {
    "claims_detail_mobile": SQL_MOBILE,
    "claims_detail_fixed": SQL_FIXED,
    "claims_detail_salted": SQL_MOBILE,
}

"""Claims x rated-call matching with operator-catalogue enrichment.

A claim matches a call when its subscription number is the call's origin
**or** its destination. Spark plans that disjunction as a Cartesian product,
so the calls are exploded to one row per *distinct* number of the call and
joined on equality: a self-call (origin = destination) still yields one row,
a NULL number never matches, duplicated claims or calls multiply as in a
plain join.

Physical strategy:

* claims side proven small (bounded count) -> broadcast hash join, the call
  table is streamed once and never shuffled;
* otherwise -> shuffle join with hot numbers salted over several tasks
  (one number may carry a large share of all calls).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabkit.functions.keys import numeric_text_key
from tabkit.plans.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_bounded
from tabkit.plans.skew import DEFAULT_HOT_ROWS, DEFAULT_SALT_BUCKETS, salted_join

# Fixed values of the source jobs (must stay equal for equal output).
TEMPLATE_ID = "NIFI"
EVENT_TYPE = "TASADO"
EVENT_SUBTYPE = "TASADO"
INCOMING_DIRECTION = "E"
MOBILE_SERVICE_TYPES = ("S", "V")

# Input layouts (names used by the source jobs; all text).
CLAIM_COLUMNS = [
    "ID_CORRELATIVO_RECLAMO", "CLIENTE", "SUSCRIPCION", "CICLO", "CUENTA_FINANCIERA",
    "CODIGO_CLIENTE", "ID_SUSCRIPCION", "TIPO_DOCUMENTO_CLIENTE",
    "NUMERO_DOCUMENTO_CLIENTE", "SEGMENTO",
]
MOBILE_CALL_COLUMNS = [
    "FecIni", "HoraIni", "CodSentTraf", "DurReal", "NumOri", "NumDest", "CodOper",
    "CodEstValor", "CodTipServTraf",
]
FIXED_CALL_COLUMNS = [
    "EVENT_INIT_DATE", "EVENT_INIT_TIME", "EVENT_DIRECTION", "REAL_DURATION",
    "TARGET_NUMBER", "ORIGIN_NUMBER", "OPERATOR_CODE", "REAL_COST", "BILL_ST_USER",
]
CATALOGUE_COLUMNS = ["CODE_OPER", "DESCRIPTION"]

# Normalised call layout produced by both call readers below.
CALL_COLUMNS = [
    "FECHA_INICIO_LLAMADA", "HORA_INICIO_LLAMADA", "TIPO_LLAMADA", "DURACION_LLAMADA",
    "TIPO_EVENTO", "SUBTIPO_EVENTO", "NUMERO_ORIGEN", "NUMERO_DESTINO", "CODE_OPER",
    "VALOR", "TIPO_TRAFICO",
]

# Output layout, in order.
DETAIL_COLUMNS = [
    "TEMPLATEID", "ID_CORRELATIVO_RECLAMO", "CLIENTE", "SUSCRIPCION", "CICLO",
    "CUENTA_FINANCIERA", "FECHA_INICIO_LLAMADA", "HORA_INICIO_LLAMADA", "TIPO_LLAMADA",
    "DURACION_LLAMADA", "TIPO_EVENTO", "SUBTIPO_EVENTO", "NUMERO_DESTINO",
    "DESCRIPCION_OPERADORA", "VALOR", "TIPO_TRAFICO", "CODIGO_CLIENTE", "ID_SUSCRIPCION",
    "TIPO_DOCUMENTO_CLIENTE", "NUMERO_DOCUMENTO_CLIENTE", "SEGMENTO",
]


def mobile_calls(raw: DataFrame, service_types=MOBILE_SERVICE_TYPES) -> DataFrame:
    """Mobile rated calls -> normalised layout.

    Every column is trimmed; only service types in ``service_types`` are kept
    (a disjunction on the trimmed code; NULL never passes).
    """
    t = {c: F.trim(F.col(c)) for c in MOBILE_CALL_COLUMNS}
    return raw.where(t["CodTipServTraf"].isin(*service_types)).select(
        t["FecIni"].alias("FECHA_INICIO_LLAMADA"),
        t["HoraIni"].alias("HORA_INICIO_LLAMADA"),
        t["CodSentTraf"].alias("TIPO_LLAMADA"),
        t["DurReal"].alias("DURACION_LLAMADA"),
        F.lit(EVENT_TYPE).alias("TIPO_EVENTO"),
        F.lit(EVENT_SUBTYPE).alias("SUBTIPO_EVENTO"),
        t["NumOri"].alias("NUMERO_ORIGEN"),
        t["NumDest"].alias("NUMERO_DESTINO"),
        t["CodOper"].alias("CODE_OPER"),
        t["CodEstValor"].alias("VALOR"),
        t["CodTipServTraf"].alias("TIPO_TRAFICO"),
    )


def fixed_calls(raw: DataFrame, incoming=INCOMING_DIRECTION) -> DataFrame:
    """Fixed-line rated calls -> normalised layout.

    For incoming calls (direction = ``incoming``) target and origin are
    swapped so that NUMERO_ORIGEN is always the subscriber's side; any other
    direction, NULL included, keeps the order. No trimming (as the source).
    """
    inc = F.col("EVENT_DIRECTION") == F.lit(incoming)
    return raw.select(
        F.col("EVENT_INIT_DATE").alias("FECHA_INICIO_LLAMADA"),
        F.col("EVENT_INIT_TIME").alias("HORA_INICIO_LLAMADA"),
        F.col("EVENT_DIRECTION").alias("TIPO_LLAMADA"),
        F.col("REAL_DURATION").alias("DURACION_LLAMADA"),
        F.lit(EVENT_TYPE).alias("TIPO_EVENTO"),
        F.lit(EVENT_SUBTYPE).alias("SUBTIPO_EVENTO"),
        F.when(inc, F.col("TARGET_NUMBER")).otherwise(F.col("ORIGIN_NUMBER")).alias("NUMERO_ORIGEN"),
        F.when(inc, F.col("ORIGIN_NUMBER")).otherwise(F.col("TARGET_NUMBER")).alias("NUMERO_DESTINO"),
        F.col("OPERATOR_CODE").alias("CODE_OPER"),
        F.col("REAL_COST").alias("VALOR"),
        F.col("BILL_ST_USER").alias("TIPO_TRAFICO"),
    )


def match_calls(claims: DataFrame, calls: DataFrame,
                broadcast_claims_rows: int = DEFAULT_BROADCAST_ROWS,
                hot_rows: int = DEFAULT_HOT_ROWS,
                salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Disjunctive join ``claim.SUSCRIPCION in (call.origin, call.destination)``.

    Returns claim columns + normalised call columns, one row per matching
    (claim, call) pair.
    """
    calls_k = (calls
               .withColumn("_k", F.explode(F.array_distinct(F.array(
                   numeric_text_key("NUMERO_ORIGEN"), numeric_text_key("NUMERO_DESTINO")))))
               .where(F.col("_k").isNotNull()))
    claims_k = (claims.select(*CLAIM_COLUMNS)
                .withColumn("_k", numeric_text_key("SUSCRIPCION"))
                .where(F.col("_k").isNotNull()))
    small, is_broadcast = broadcast_if_bounded(claims_k, broadcast_claims_rows)
    if is_broadcast:
        joined = calls_k.join(small, "_k", "inner")
    else:
        joined = salted_join(calls_k, claims_k, "_k", "inner", hot_rows, salt_buckets)
    return joined.drop("_k")


def enrich_operator(matched: DataFrame, catalogue: DataFrame,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join to the operator catalogue and the description fallback.

    No catalogue match -> the raw code; a match with NULL description stays
    NULL (not ``coalesce``); duplicate catalogue codes multiply rows; a NULL
    code never matches.
    """
    cat = (catalogue.select(numeric_text_key("CODE_OPER").alias("_ck"),
                            F.col("CODE_OPER").alias("_c_code"),
                            F.col("DESCRIPTION").alias("_c_desc"))
           .where(F.col("_ck").isNotNull()))
    cat, _ = broadcast_if_bounded(cat, broadcast_rows)
    m = matched.withColumn("_ck", numeric_text_key("CODE_OPER"))
    out = m.join(cat, "_ck", "left")
    return out.withColumn(
        "DESCRIPCION_OPERADORA",
        F.when(F.col("_c_code").isNull(), F.col("CODE_OPER")).otherwise(F.col("_c_desc")),
    ).drop("_ck", "_c_code", "_c_desc")


def claims_detail(claims: DataFrame, calls: DataFrame, catalogue: DataFrame,
                  broadcast_claims_rows: int = DEFAULT_BROADCAST_ROWS,
                  broadcast_catalogue_rows: int = DEFAULT_BROADCAST_ROWS,
                  hot_rows: int = DEFAULT_HOT_ROWS,
                  salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Full claims-detail table (21 text columns, fixed order).

    ``calls`` must already be in the normalised layout (``mobile_calls`` or
    ``fixed_calls``).
    """
    matched = match_calls(claims, calls, broadcast_claims_rows, hot_rows, salt_buckets)
    enriched = enrich_operator(matched, catalogue, broadcast_catalogue_rows)
    return enriched.select(
        F.lit(TEMPLATE_ID).alias("TEMPLATEID"),
        *[F.col(c) for c in DETAIL_COLUMNS[1:]],
    )


def literal_or_join(claims: DataFrame, calls: DataFrame) -> DataFrame:
    """The join exactly as written in the source jobs (for comparison only:
    Spark plans it as a nested-loop / Cartesian join)."""
    r = claims.alias("R")
    t = calls.alias("T")
    cond = ((numeric_text_key(F.col("R.SUSCRIPCION")) == numeric_text_key(F.col("T.NUMERO_ORIGEN")))
            | (numeric_text_key(F.col("R.SUSCRIPCION")) == numeric_text_key(F.col("T.NUMERO_DESTINO"))))
    return r.join(t, cond, "inner").select("R.*", "T.*")

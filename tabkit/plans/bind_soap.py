"""SOAP mapping bound to ``conversations``: every turn becomes one cancel
(and one close) message, rendered by Spark from the full turn text; the
sentences of the text are the repeated characteristics. The messages are
then parsed and mapped like files from a landing folder."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from tabkit.jobs import cancel_mapping_job
from tabkit.operators import soap
from tabkit.plans.bind_sources import staging
from tabkit.plans.tables import table
from tabkit.sinks.files import write_named_text

_SOAP = "http://schemas.xmlsoap.org/soap/envelope/"


def _t(tag, c):
    return F.concat(F.lit(f"<{tag}>"), soap.xml_text(c), F.lit(f"</{tag}>"))


def cancel_messages(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    sentences = F.split(F.col("text"), "[.]")
    chars = F.array_join(F.transform(sentences, lambda s, i: F.concat(
        F.lit("<b:Characteristic>"), _t("b:name", F.concat(F.lit("s"), i.cast("string"))),
        _t("b:value", s), F.lit("</b:Characteristic>"))), "")
    header = F.concat(
        F.lit("<h:HeaderIn>"), _t("h:country", F.lit("PE")), _t("h:lang", F.col("role")),
        _t("h:entity", cid), _t("h:system", F.lit("CRM")), _t("h:subsystem", F.lit("TT")),
        _t("h:originator", F.col("role")), _t("h:userId", F.concat(F.lit("u"), cid)),
        _t("h:operation", F.lit("cancel")),
        F.when(F.col("role") == "user", _t("h:pid", turn)).otherwise(F.lit("")),
        _t("h:execId", F.concat(cid, F.lit("-"), turn)), _t("h:timestamp", F.lit("2024-01-01T00:00:00")),
        F.lit("</h:HeaderIn>"))
    body = F.concat(
        F.lit("<b:cancelTroubleTicketRequest>"), _t("b:interactionDate", F.lit("2024-01-01")),
        _t("b:externalId", F.concat(cid, F.lit("/"), turn)),
        F.lit("<b:relatedObjectList><b:RelatedObject>"), _t("b:involvement", F.col("role")),
        F.lit("<b:describeByList>"), chars, F.lit("</b:describeByList></b:RelatedObject></b:relatedObjectList>"),
        F.lit("</b:cancelTroubleTicketRequest>"))
    doc = F.concat(F.lit(f'<s:Envelope xmlns:s="{_SOAP}" xmlns:h="urn:in:h" xmlns:b="urn:in:b"><s:Header>'),
                   header, F.lit("</s:Header><s:Body>"), body, F.lit("</s:Body></s:Envelope>"))
    return c.select(F.concat(cid, F.lit("_"), turn, F.lit(".xml")).alias("file_name"), doc.alias("value"))


def q_cancel_mapping(spark: SparkSession, sf_dir: str):
    m = soap.map_cancel(cancel_messages(spark, sf_dir))
    rel = F.col("related")[0]
    return m.select("file_name", "valid", "lang", "pid", "externalId",
                    rel["involvement"].alias("involvement"),
                    F.size(rel["characteristics"]).cast("bigint").alias("n_characteristics"),
                    rel["characteristics"][0]["value"].alias("first_value"),
                    F.try_element_at(rel["characteristics"], F.lit(-1))["value"].alias("last_value"))


SQL_CANCEL_MAPPING = """
SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.xml' AS file_name, TRUE AS valid,
       role AS lang, CASE WHEN role = 'user' THEN CAST(turn AS VARCHAR) ELSE '' END AS pid,
       CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS externalId, role AS involvement,
       CAST(len(string_split(text, '.')) AS BIGINT) AS n_characteristics,
       string_split(text, '.')[1] AS first_value, string_split(text, '.')[-1] AS last_value
FROM conversations"""


def q_cancel_render(spark: SparkSession, sf_dir: str):
    ok, _ = soap.cancel_job(cancel_messages(spark, sf_dir))
    return ok


def close_messages(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    tef = F.concat(F.lit("<v:TefHeaderReq>"), _t("v:userLogin", F.concat(F.lit("u"), cid)),
                   _t("v:sessionCode", turn), _t("v:application", F.lit("CRM")),
                   _t("v:idMessage", F.concat(cid, F.lit("-"), turn)),
                   _t("v:transactionTimestamp", F.lit("2024-01-01T00:00:00")), F.lit("</v:TefHeaderReq>"))
    data = F.concat(
        F.lit("<t:CloseCustomerProblemRequest_data><t:problemReference>"), _t("t:id", cid),
        F.when(F.col("role") == "assistant", _t("t:referenceNumber", turn)).otherwise(F.lit("")),
        F.lit("</t:problemReference><t:closeSummariesList><t:problemSummary><t:problemResolution>"),
        _t("t:code", F.col("role")), _t("t:value", F.col("text")),
        F.lit("</t:problemResolution></t:problemSummary></t:closeSummariesList><t:problemStatus>"),
        _t("t:code", F.lit("CLOSED")), F.lit("</t:problemStatus></t:CloseCustomerProblemRequest_data>"))
    doc = F.concat(F.lit(f'<s:Envelope xmlns:s="{_SOAP}" xmlns:t="urn:in:t" xmlns:v="urn:in:v"><s:Header/><s:Body>'
                         '<t:CloseCustomerProblemRequest>'), tef, data,
                   F.lit("</t:CloseCustomerProblemRequest></s:Body></s:Envelope>"))
    return c.select(F.concat(cid, F.lit("_"), turn, F.lit(".xml")).alias("file_name"), doc.alias("value"))


def q_close_mapping(spark: SparkSession, sf_dir: str):
    return soap.map_close(close_messages(spark, sf_dir))


SQL_CLOSE_MAPPING = """
SELECT CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.xml' AS file_name, TRUE AS valid,
       NULL::VARCHAR AS reason,
       'u' || CAST(conv_id AS VARCHAR) AS userLogin, CAST(turn AS VARCHAR) AS sessionCode, 'CRM' AS application,
       CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS idMessage,
       '2024-01-01T00:00:00' AS transactionTimestamp, CAST(conv_id AS VARCHAR) AS id,
       CASE WHEN role = 'assistant' THEN CAST(turn AS VARCHAR) ELSE '' END AS referenceNumber,
       role AS resolution_code, text AS resolution_value, 'CLOSED' AS status_code, '' AS status_value
FROM conversations"""


def q_close_render(spark: SparkSession, sf_dir: str):
    ok, _ = soap.close_job(close_messages(spark, sf_dir))
    return ok


def _sql_text(x: str) -> str:
    """The rendered text of ``x``: escaped, non-ASCII as decimal references."""
    esc = f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return (f"array_to_string(list_transform(regexp_extract_all({esc}, '(?s).'), "
            f"lambda c: CASE WHEN unicode(c) > 127 THEN '&#' || unicode(c) || ';' ELSE c END), '')")


def _sql_leaf(tag: str, x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '<{tag} />' ELSE '<{tag}>' || {_sql_text(x)} || '</{tag}>' END"


_FILE = "CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) || '.xml'"
_CID, _TURN = "CAST(conv_id AS VARCHAR)", "CAST(turn AS VARCHAR)"
_HEADER = {"country": "'PE'", "lang": "role", "entity": _CID, "system": "'CRM'", "subsystem": "'TT'", "originator": "role",
           "userId": f"'u' || {_CID}", "operation": "'cancel'", "pid": f"CASE WHEN role = 'user' THEN {_TURN} ELSE '' END",
           "execId": f"{_CID} || '-' || {_TURN}", "msgId": "''", "timestamp": "'2024-01-01T00:00:00'", "msgType": "''"}

def _sql_cancel_xml(header: dict[str, str], more_objects: str = "''") -> str:
    return f"""
  '<soapenv:Envelope xmlns:soapenv="{_SOAP}" xmlns:head="{soap.CancelNamespaces.head}" xmlns:v1="{soap.CancelNamespaces.v1}">'
  || '<soapenv:Header><head:HeaderIn>' || {" || ".join(_sql_leaf(f"head:{k}", f"({v})") for k, v in header.items())}
  || '</head:HeaderIn></soapenv:Header><soapenv:Body><v1:cancelTroubleTicketRequest><v1:interactionDate>2024-01-01</v1:interactionDate><v1:ID />'
  || '<v1:externalId>' || {_CID} || '/' || {_TURN} || '</v1:externalId><v1:relatedObjectList><v1:RelatedObject>'
  || {_sql_leaf("v1:involvement", "role")} || '<v1:describeByList>'
  || array_to_string(list_transform(range(len(string_split(text, '.'))), lambda i: '<v1:Characteristic><v1:name>s' || i || '</v1:name>'
       || {_sql_leaf("v1:value", "string_split(text, '.')[i + 1]")} || '</v1:Characteristic>'), '')
  || '</v1:describeByList></v1:RelatedObject>' || {more_objects}
  || '</v1:relatedObjectList></v1:cancelTroubleTicketRequest></soapenv:Body></soapenv:Envelope>'"""


SQL_CANCEL_RENDER = f"SELECT {_FILE} AS file_name, {_sql_cancel_xml(_HEADER)} AS xml FROM conversations"

SQL_CLOSE_RENDER = f"""
SELECT {_FILE} AS file_name,
  '<soapenv:Envelope xmlns:soapenv="{_SOAP}" xmlns:typ="{soap.CloseNamespaces.typ}" xmlns:v1="{soap.CloseNamespaces.v1}">'
  || '<soapenv:Header /><soapenv:Body><v1:CloseCustomerProblemRequest><v1:TefHeaderReq><v1:userLogin>u' || {_CID} || '</v1:userLogin>'
  || '<v1:sessionCode>' || {_TURN} || '</v1:sessionCode><v1:application>CRM</v1:application><v1:idMessage>' || {_CID} || '-' || {_TURN}
  || '</v1:idMessage><v1:transactionTimestamp>2024-01-01T00:00:00</v1:transactionTimestamp></v1:TefHeaderReq>'
  || '<typ:CloseCustomerProblemRequest_data><typ:problemReference><typ:id>' || {_CID} || '</typ:id>'
  || CASE WHEN role = 'assistant' THEN '<typ:referenceNumber>' || {_TURN} || '</typ:referenceNumber>' ELSE '<typ:referenceNumber />' END
  || '</typ:problemReference><typ:closeSummariesList><typ:problemSummary><typ:problemResolution>' || {_sql_leaf("typ:code", "role")}
  || {_sql_leaf("typ:value", "text")} || '</typ:problemResolution></typ:problemSummary></typ:closeSummariesList><typ:problemStatus>'
  || '<typ:code>CLOSED</typ:code><typ:value /></typ:problemStatus></typ:CloseCustomerProblemRequest_data></v1:CloseCustomerProblemRequest></soapenv:Body></soapenv:Envelope>' AS xml
FROM conversations"""


def namespaced_messages(spark: SparkSession, sf_dir: str):
    """The cancel messages, each with a second header of another namespace,
    and by turn: as they are; declared in single quotes; the request in a
    default namespace; the request in another namespace, whose right URI
    stands in a comment only."""
    m = cancel_messages(spark, sf_dir)
    decoy = '<d:HeaderIn xmlns:d="urn:decoy"><d:lang>decoy</d:lang></d:HeaderIn></s:Header>'
    v = F.replace("value", F.lit("</s:Header>"), F.lit(decoy))
    put = lambda c, *pairs: put(F.replace(c, F.lit(pairs[0][0]), F.lit(pairs[0][1])), *pairs[1:]) if pairs else c
    kind = F.pmod(F.regexp_extract("file_name", r"_(\d+)\.xml$", 1).cast("bigint"), F.lit(4))
    single = put(v, ('xmlns:h="urn:in:h"', "xmlns:h = 'urn:in:h'"), ('xmlns:b="urn:in:b"', "xmlns:b='urn:in:b'"))
    default = put(v, ("<b:", "<"), ("</b:", "</"), ('xmlns:b="urn:in:b"', 'xmlns="urn:in:b"'))
    comment = put(v, ('xmlns:b="urn:in:b">', 'xmlns:b="urn:in:other"><!-- xmlns:b="urn:in:b" -->'))
    return m.withColumn("value", F.when(kind == 0, v).when(kind == 1, single).when(kind == 2, default).otherwise(comment))


def q_cancel_mapping_by_uri(spark: SparkSession, sf_dir: str):
    m = soap.map_cancel(namespaced_messages(spark, sf_dir), uris=soap.cancel_uris(_SOAP, "urn:in:h", "urn:in:b"))
    return m.select("file_name", "valid", *soap.HEADER_FIELDS, "interactionDate", "externalId",
                    F.get("related", F.lit(0))["involvement"].alias("involvement"),
                    F.array_join(F.transform(F.flatten(F.transform("related", lambda r: r["characteristics"])), lambda c: F.concat(c["name"], F.lit("="), c["value"])), "|").alias("characteristics"))


_FOUND = "turn % 4 <> 3"
SQL_CANCEL_MAPPING_BY_URI = f"""
SELECT {_FILE} AS file_name, TRUE AS valid, {", ".join(f"{v} AS {k}" for k, v in _HEADER.items())},
       CASE WHEN {_FOUND} THEN '2024-01-01' END AS "interactionDate", CASE WHEN {_FOUND} THEN {_CID} || '/' || {_TURN} END AS "externalId",
       CASE WHEN {_FOUND} THEN role END AS involvement,
       CASE WHEN {_FOUND} THEN array_to_string(list_transform(range(len(string_split(text, '.'))), lambda i: 's' || i || '=' || string_split(text, '.')[i + 1]), '|') ELSE '' END AS characteristics
FROM conversations"""


def flawed_messages(spark: SparkSession, sf_dir: str):
    """The cancel messages, by turn: as they are; cut off; without a required
    header field; without a required field of the related object; with a
    second header and a second related object."""
    m = cancel_messages(spark, sf_dir)
    v = F.col("value")
    second = F.regexp_replace(F.regexp_extract("value", "(?s)<h:HeaderIn>.*</h:HeaderIn>", 0), "<h:lang>[^<]*<", "<h:lang>last<")
    more = "<b:RelatedObject><b:involvement>second</b:involvement></b:RelatedObject></b:relatedObjectList>"
    twice = F.replace(F.replace(v, F.lit("</s:Header>"), F.concat(second, F.lit("</s:Header>"))), F.lit("</b:relatedObjectList>"), F.lit(more))
    kind = F.pmod(F.regexp_extract("file_name", r"_(\d+)\.xml$", 1).cast("bigint"), F.lit(5))
    return m.withColumn("value", F.when(kind == 0, v).when(kind == 1, F.replace(v, F.lit("</s:Envelope>"), F.lit("")))
                        .when(kind == 2, F.regexp_replace(v, "<h:timestamp>[^<]*</h:timestamp>", ""))
                        .when(kind == 3, F.regexp_replace(v, "<b:involvement>[^<]*</b:involvement>", "")).otherwise(twice))


def q_cancel_files(spark: SparkSession, sf_dir: str):
    """The job over message files, a file each: rendered messages and
    reasons of the rejected ones, as it writes them."""
    root = staging(spark, "messages")
    write_named_text(flawed_messages(spark, sf_dir), f"{root}/in", "file_name", "value", one_dir_per_name=True)
    cancel_mapping_job(spark, f"{root}/in", f"{root}/out", f"{root}/rejects", by_folder="file_name")
    none = F.lit(None).cast("string")
    ok, bad = spark.read.parquet(f"{root}/out"), spark.read.parquet(f"{root}/rejects")
    return ok.select("file_name", none.alias("reason"), "xml").unionByName(bad.select("file_name", "reason", none.alias("xml")))


_SECOND = "CASE WHEN turn % 5 = 4 THEN '<v1:RelatedObject><v1:involvement>second</v1:involvement><v1:describeByList /></v1:RelatedObject>' ELSE '' END"
_LAST_HEADER = {**_HEADER, "lang": "CASE WHEN turn % 5 = 4 THEN 'last' ELSE role END"}
SQL_CANCEL_FILES = f"""
SELECT {_FILE} AS file_name,
       CASE turn % 5 WHEN 1 THEN 'malformed XML' WHEN 2 THEN 'HeaderIn: required field missing' WHEN 3 THEN 'RelatedObject: involvement missing' END AS reason,
       CASE WHEN turn % 5 IN (0, 4) THEN {_sql_cancel_xml(_LAST_HEADER, _SECOND)} END AS xml
FROM conversations"""


QUERIES = {
    "cancel_mapping": q_cancel_mapping,
    "cancel_files": q_cancel_files,
    "cancel_mapping_by_uri": q_cancel_mapping_by_uri,
    "cancel_render": q_cancel_render,
    "close_mapping": q_close_mapping,
    "close_render": q_close_render,
}
SQL = {"cancel_mapping": SQL_CANCEL_MAPPING, "cancel_files": SQL_CANCEL_FILES, "close_mapping": SQL_CLOSE_MAPPING, "cancel_mapping_by_uri": SQL_CANCEL_MAPPING_BY_URI,
       "cancel_render": SQL_CANCEL_RENDER, "close_render": SQL_CLOSE_RENDER}

"""Bulk mapping of SOAP trouble-ticket messages (cancel / close) to tables
and to re-rendered messages.

The source scripts handle one file per process with ElementTree. Here a
folder of messages is one text scan (``wholetext``: one row per file), parsed
by ``from_xml`` against an explicit nested schema (namespace prefixes
ignored), flattened with array functions and rendered back to text with
column expressions -- one stage, no shuffle, no Python per row except for
the walk of ``by_uri``.

Rules kept from the source:

* repeated single-value parents: the **last** one wins;
* repeated list items (related objects, characteristics) are all kept, in
  document order, across every list container;
* optional leaves absent -> ``''``; a required leaf absent inside a present
  container rejects the whole message (reason recorded); a present but empty
  required leaf is valid; an absent container leaves empty tags;
* the cancel output's ``ID`` element is never filled.

Rendering follows ElementTree's default ``write``: no XML declaration,
``<tag />`` for empty elements, ``& < >`` escaped in text and every
non-ASCII character written as a decimal character reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class CancelNamespaces:
    """URIs declared on the rendered cancel message (prefixes soapenv/head/v1)."""
    soapenv: str = "http://schemas.xmlsoap.org/soap/envelope/"
    head: str = "urn:example:header"
    v1: str = "urn:example:modifyTroubleTicket:v1"


@dataclass(frozen=True)
class CloseNamespaces:
    """URIs declared on the rendered close message (prefixes soapenv/typ/v1)."""
    soapenv: str = "http://schemas.xmlsoap.org/soap/envelope/"
    typ: str = "urn:example:troubleTicketing:types"
    v1: str = "urn:example:requestHeader:v1"


# Element names and their order in the cancel header.
HEADER_FIELDS = ["country", "lang", "entity", "system", "subsystem", "originator", "userId",
                 "operation", "pid", "execId", "msgId", "timestamp", "msgType"]
HEADER_OPTIONAL = ["pid", "msgId", "msgType"]
TEF_FIELDS = ["userLogin", "sessionCode", "application", "idMessage", "transactionTimestamp"]

_S = "string"
_CHAR = "struct<name: string, value: string>"
_OBJ = f"struct<involvement: string, describeByList: array<struct<Characteristic: array<{_CHAR}>>>>"
_REQ = (f"struct<interactionDate: string, externalId: string, "
        f"relatedObjectList: array<struct<RelatedObject: array<{_OBJ}>>>>")
_HDR = "struct<" + ", ".join(f"{f}: {_S}" for f in HEADER_FIELDS) + ">"
CANCEL_SCHEMA = (f"Header array<struct<HeaderIn: array<{_HDR}>>>, "
                 f"Body array<struct<cancelTroubleTicketRequest: array<{_REQ}>>>, "
                 f"_corrupt_record string")

_CODEV = "struct<code: string, value: string>"
_DATA = (f"struct<problemReference: array<struct<id: string, referenceNumber: string>>, "
         f"closeSummariesList: array<struct<problemSummary: array<struct<problemResolution: array<{_CODEV}>>>>>, "
         f"problemStatus: array<{_CODEV}>>")
_TEF = "struct<" + ", ".join(f"{f}: {_S}" for f in TEF_FIELDS) + ">"
CLOSE_SCHEMA = (f"Body array<struct<CloseCustomerProblemRequest: array<struct<"
                f"TefHeaderReq: array<{_TEF}>, CloseCustomerProblemRequest_data: array<{_DATA}>>>>>, "
                f"_corrupt_record string")

_XML_OPTS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false",
             "columnNameOfCorruptRecord": "_corrupt_record"}


# ---- scan -------------------------------------------------------------------

def read_messages(spark: SparkSession, path: str, by_folder: str | None = None) -> DataFrame:
    """One row per message file: ``(file_name, value)``. With ``by_folder``
    the messages lie as ``write_named_text`` writes them, one folder
    ``<by_folder>=<name>`` each, and the name is the folder's."""
    name = F.col("_metadata.file_name")
    if by_folder:   # the name is escaped in the folder's name, and that in the file's address
        decoded = lambda c: F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
        name = decoded(decoded(F.regexp_extract(F.col("_metadata.file_path"), f"/{by_folder}=([^/]*)/[^/]*$", 1)))
        # the folders' names are taken from the paths, not inferred as values of a column
        return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(name.alias("file_name"), "value")
    return spark.read.text(path, wholetext=True).select(name.alias("file_name"), "value")


# ---- array helpers ------------------------------------------------------------

def _cat(arr: Column, field: str, elem_type: str) -> Column:
    """Concatenate ``x[field]`` (an array) over every element of ``arr``;
    NULL containers count as empty."""
    empty = F.array().cast(f"array<{elem_type}>")
    return F.coalesce(F.flatten(F.transform(arr, lambda x: F.coalesce(x[field], empty))), empty)


def _last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def _all(arr: Column, pred) -> Column:
    return F.coalesce(F.forall(arr, pred), F.lit(True))


# ---- text rendering -----------------------------------------------------------

def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def xml_text(s: Column) -> Column:
    """ElementTree text escaping with ASCII output."""
    def ascii_only(esc: Column) -> Column:
        runs = F.regexp_extract_all(esc, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), 0)
        refs = F.array_join(F.transform(runs, lambda c: F.when(
            F.ascii(c) > 127, F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)), "")
        # text without non-ASCII characters is not taken apart
        return F.when(F.octet_length(esc) > F.length(esc), refs).otherwise(esc)

    amp, lt, gt = (F.lit(c) for c in "&<>")
    return once(F.replace(F.replace(F.replace(s, amp, F.lit("&amp;")), lt, F.lit("&lt;")), gt, F.lit("&gt;")), ascii_only)


def leaf(tag: str, text: Column | None) -> Column:
    if text is None:
        return F.lit(f"<{tag} />")
    return F.when(text.isNull() | (text == ""), F.lit(f"<{tag} />")).otherwise(
        F.concat(F.lit(f"<{tag}>"), xml_text(text), F.lit(f"</{tag}>")))


def node(tag: str, body: Column, items: Column | None = None) -> Column:
    """Element with rendered children ``body``, which is named once: nested
    elements would otherwise render their leaves twice a level. A body that may
    be empty gives the array it is rendered from as ``items`` (``<tag />``
    without any)."""
    full = F.concat(F.lit(f"<{tag}>"), body, F.lit(f"</{tag}>"))
    return full if items is None else F.when(F.size(items) == 0, F.lit(f"<{tag} />")).otherwise(full)


def _root(tag: str, attrs: list[tuple[str, str]], body: Column) -> Column:
    a = "".join(f' {k}="{v}"' for k, v in attrs)
    return F.concat(F.lit(f"<{tag}{a}>"), body, F.lit(f"</{tag}>"))


# ---- namespaces -----------------------------------------------------------------

_TOKEN = r"<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|<\?[\s\S]*?\?>|<(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_ATTRIBUTE = r"([^\s=<>\"'/]+)\s*=\s*(\"[^\"]*+\"|'[^']*+')"


def cancel_uris(envelope: str, header: str, request: str) -> dict[str, str]:
    """Element -> URI of the cancel message, for ``by_uri``."""
    own = {"cancelTroubleTicketRequest", "interactionDate", "externalId", "relatedObjectList", "RelatedObject",
           "involvement", "describeByList", "Characteristic", "name", "value"}
    return {**dict.fromkeys(own, request), **dict.fromkeys(["HeaderIn", *HEADER_FIELDS], header),
            **dict.fromkeys(["Envelope", "Header", "Body"], envelope)}


def close_uris(envelope: str, types: str, header: str) -> dict[str, str]:
    """Element -> URI of the close message, for ``by_uri``."""
    own = {"CloseCustomerProblemRequest_data", "problemReference", "id", "referenceNumber", "closeSummariesList",
           "problemSummary", "problemResolution", "problemStatus", "code", "value"}
    return {**dict.fromkeys(own, types), **dict.fromkeys(["CloseCustomerProblemRequest", "TefHeaderReq", *TEF_FIELDS], header),
            **dict.fromkeys(["Envelope", "Header", "Body"], envelope)}


def by_uri(text: Column, uris: dict[str, str]) -> Column:
    """The message with every element of ``uris`` (local name -> URI, '' for
    none) that is in another namespace renamed, so that no mapping finds it.
    One walk over the tags of a message, by a small function in the tasks.

    A prefix means what the nearest enclosing declaration says: the walk over
    the tags keeps the declarations in scope with their depth. Quotes of
    either kind, default namespaces, redeclared prefixes and undeclared ones
    are told apart; what stands in comments, processing instructions, CDATA
    or attribute values declares nothing. NULL stays NULL."""
    def renamed(message):
        import re

        if message is None:
            return None
        name_of, attribute = re.compile(r"</?([^\s/>]+)", re.A), re.compile(_ATTRIBUTE, re.A)
        depth, scope = 0, []    # (depth, prefix, URI) of the declarations in scope

        def shown(m):
            nonlocal depth, scope
            tag = m[0]
            if tag.startswith(("<!", "<?")):
                return tag
            end, single = tag.startswith("</"), tag.endswith("/>")
            name = found[1] if (found := name_of.match(tag)) else ""
            if not end:
                depth += 1
                if "xmlns" in tag:
                    scope = scope + [(depth, k[6:].rpartition(":")[2], v[1:-1].replace("&amp;", "&"))
                                     for k, v in attribute.findall(tag) if k == "xmlns" or k.startswith("xmlns:")]
            local = name.rpartition(":")[2]
            if local in uris:
                prefix = name.partition(":")[0] if ":" in name else ""
                uri = next((u for _, p, u in reversed(scope) if p == prefix), None if prefix else "")
                if uri != uris[local]:
                    tag = f"{'</' if end else '<'}_other.{local}{tag[len(name) + 1 + end:]}"
            if end or single:
                scope = [d for d in scope if d[0] < depth]
                depth -= 1
            return tag

        return re.sub(_TOKEN, shown, message, flags=re.A)

    return F.udf(renamed, "string", useArrow=True)(text)


# ---- cancel -------------------------------------------------------------------

def _computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name``, computed once a row: filters and
    projections over a generated column do not compute its value again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _ns_guard(reason: Column, text: Column, require_ns: str | None) -> Column:
    """Optional check of the text: it must hold the expected URI in double
    quotes (elements are matched by URI with ``uris``)."""
    if not require_ns:
        return reason
    return F.when(reason.isNull() & ~text.contains(F.lit(f'"{require_ns}"')),
                  F.lit(f"namespace {require_ns} not declared")).otherwise(reason)


def map_cancel(messages: DataFrame, text_col: str = "value", require_ns: str | None = None, uris: dict[str, str] | None = None) -> DataFrame:
    """Parse + flatten cancel messages: one row per message with ``valid``,
    ``reason``, the 13 header fields, ``interactionDate``, ``ID`` (always
    empty), ``externalId`` and ``related`` =
    ``array<struct<involvement, characteristics: array<struct<name, value>>>>``.
    Elements are matched by local name, or by URI with ``uris`` (``cancel_uris``)."""
    x = F.from_xml(by_uri(F.col(text_col), uris) if uris else F.col(text_col), CANCEL_SCHEMA, _XML_OPTS)
    m = _computed(messages, "_x", x)
    m = _computed(m, "_in", F.struct(_cat(F.col("_x.Header"), "HeaderIn", _HDR).alias("hdrs"),
                                     _cat(F.col("_x.Body"), "cancelTroubleTicketRequest", _REQ).alias("reqs")))
    hdrs, reqs = F.col("_in.hdrs"), F.col("_in.reqs")
    objs = F.flatten(F.transform(reqs, lambda r: _cat(r["relatedObjectList"], "RelatedObject", _OBJ)))
    m = _computed(m, "_related", F.transform(objs, lambda o: F.struct(
        o["involvement"].alias("involvement"),
        _cat(o["describeByList"], "Characteristic", _CHAR).alias("characteristics"))))
    related = F.col("_related")
    required_hdr = [f for f in HEADER_FIELDS if f not in HEADER_OPTIONAL]
    hdr_ok = _all(hdrs, lambda h: F.greatest(*[h[f].isNull() for f in required_hdr]) == F.lit(False))
    req_ok = _all(reqs, lambda r: r["interactionDate"].isNotNull() & r["externalId"].isNotNull())
    obj_ok = _all(related, lambda o: o["involvement"].isNotNull())
    chr_ok = _all(related, lambda o: _all(o["characteristics"],
                                          lambda c: c["name"].isNotNull() & c["value"].isNotNull()))
    corrupt = F.col("_x._corrupt_record").isNotNull()
    reason = (F.when(corrupt, F.lit("malformed XML"))
              .when(~hdr_ok, F.lit("HeaderIn: required field missing"))
              .when(~req_ok, F.lit("cancelTroubleTicketRequest: interactionDate/externalId missing"))
              .when(~obj_ok, F.lit("RelatedObject: involvement missing"))
              .when(~chr_ok, F.lit("Characteristic: name/value missing")))
    m, reason = _computed(m, "_reason", _ns_guard(reason, F.col(text_col), require_ns)), F.col("_reason")
    last_h = _last(hdrs)
    last_r = _last(reqs)
    has_h = F.size(hdrs) > 0
    fields = [F.when(has_h & F.lit(f in HEADER_OPTIONAL), F.coalesce(last_h[f], F.lit("")))
              .otherwise(last_h[f]).alias(f) for f in HEADER_FIELDS]
    keep = [c for c in messages.columns if c != text_col]
    return m.select(*keep, reason.isNull().alias("valid"), reason.alias("reason"), *fields,
                    last_r["interactionDate"].alias("interactionDate"),
                    F.lit(None).cast("string").alias("ID"),
                    last_r["externalId"].alias("externalId"),
                    related.alias("related"))


def render_cancel(mapped: DataFrame, ns: CancelNamespaces = CancelNamespaces()) -> Column:
    header = node("head:HeaderIn", F.concat(*[leaf(f"head:{f}", F.col(f)) for f in HEADER_FIELDS]))
    chars = lambda o: F.array_join(F.transform(o["characteristics"], lambda c: node(
        "v1:Characteristic", F.concat(leaf("v1:name", c["name"]), leaf("v1:value", c["value"])))), "")
    objs = F.array_join(F.transform(F.col("related"), lambda o: node("v1:RelatedObject", F.concat(
        leaf("v1:involvement", o["involvement"]), node("v1:describeByList", chars(o), o["characteristics"])))), "")
    body = node("v1:cancelTroubleTicketRequest", F.concat(
        leaf("v1:interactionDate", F.col("interactionDate")), leaf("v1:ID", F.col("ID")),
        leaf("v1:externalId", F.col("externalId")), node("v1:relatedObjectList", objs, F.col("related"))))
    return _root("soapenv:Envelope",
                 [("xmlns:soapenv", ns.soapenv), ("xmlns:head", ns.head), ("xmlns:v1", ns.v1)],
                 F.concat(node("soapenv:Header", header), node("soapenv:Body", body)))


# ---- close --------------------------------------------------------------------

def map_close(messages: DataFrame, text_col: str = "value", require_ns: str | None = None, uris: dict[str, str] | None = None) -> DataFrame:
    """Parse + flatten close messages: ``valid``, ``reason``, the 5 request
    header fields, problem ``id``/``referenceNumber``, resolution
    ``resolution_code``/``resolution_value``, ``status_code``/``status_value``."""
    x = F.from_xml(by_uri(F.col(text_col), uris) if uris else F.col(text_col), CLOSE_SCHEMA, _XML_OPTS)
    m = _computed(messages, "_x", x)
    m = _computed(m, "_reqs", _cat(F.col("_x.Body"), "CloseCustomerProblemRequest",
                                   f"struct<TefHeaderReq: array<{_TEF}>, CloseCustomerProblemRequest_data: array<{_DATA}>>"))
    reqs = F.col("_reqs")
    tefs = F.flatten(F.transform(reqs, lambda r: F.coalesce(r["TefHeaderReq"], F.array().cast(f"array<{_TEF}>"))))
    datas = F.flatten(F.transform(reqs, lambda r: F.coalesce(r["CloseCustomerProblemRequest_data"],
                                                             F.array().cast(f"array<{_DATA}>"))))
    refs = F.flatten(F.transform(datas, lambda d: F.coalesce(
        d["problemReference"], F.array().cast("array<struct<id: string, referenceNumber: string>>"))))
    sums = F.flatten(F.transform(datas, lambda d: _cat(d["closeSummariesList"], "problemSummary",
                                                         f"struct<problemResolution: array<{_CODEV}>>")))
    ress = _cat(sums, "problemResolution", _CODEV)
    stats = F.flatten(F.transform(datas, lambda d: F.coalesce(d["problemStatus"], F.array().cast(f"array<{_CODEV}>"))))
    m = _computed(m, "_in", F.struct(tefs.alias("tefs"), refs.alias("refs"), ress.alias("ress"), stats.alias("stats")))
    tefs, refs, ress, stats = (F.col(f"_in.{f}") for f in ("tefs", "refs", "ress", "stats"))
    tef_ok = _all(tefs, lambda t: F.greatest(*[t[f].isNull() for f in TEF_FIELDS]) == F.lit(False))
    ref_ok = _all(refs, lambda r: r["id"].isNotNull())
    res_ok = _all(ress, lambda r: r["code"].isNotNull())
    st_ok = _all(stats, lambda r: r["code"].isNotNull())
    reason = (F.when(F.col("_x._corrupt_record").isNotNull(), F.lit("malformed XML"))
              .when(~tef_ok, F.lit("TefHeaderReq: required field missing"))
              .when(~ref_ok, F.lit("problemReference: id missing"))
              .when(~res_ok, F.lit("problemResolution: code missing"))
              .when(~st_ok, F.lit("problemStatus: code missing")))
    m, reason = _computed(m, "_reason", _ns_guard(reason, F.col(text_col), require_ns)), F.col("_reason")
    lt, lr, ls, lst = _last(tefs), _last(refs), _last(ress), _last(stats)
    opt = lambda last, f: F.when(last.isNotNull(), F.coalesce(last[f], F.lit(""))).otherwise(last[f])
    keep = [c for c in messages.columns if c != text_col]
    return m.select(*keep, reason.isNull().alias("valid"), reason.alias("reason"),
                    *[lt[f].alias(f) for f in TEF_FIELDS],
                    lr["id"].alias("id"), opt(lr, "referenceNumber").alias("referenceNumber"),
                    ls["code"].alias("resolution_code"), opt(ls, "value").alias("resolution_value"),
                    lst["code"].alias("status_code"), opt(lst, "value").alias("status_value"))


def render_close(mapped: DataFrame, ns: CloseNamespaces = CloseNamespaces()) -> Column:
    tef = node("v1:TefHeaderReq", F.concat(*[leaf(f"v1:{f}", F.col(f)) for f in TEF_FIELDS]))
    data = node("typ:CloseCustomerProblemRequest_data", F.concat(
        node("typ:problemReference", F.concat(leaf("typ:id", F.col("id")),
                                              leaf("typ:referenceNumber", F.col("referenceNumber")))),
        node("typ:closeSummariesList", node("typ:problemSummary", node("typ:problemResolution", F.concat(
            leaf("typ:code", F.col("resolution_code")), leaf("typ:value", F.col("resolution_value")))))),
        node("typ:problemStatus", F.concat(leaf("typ:code", F.col("status_code")),
                                           leaf("typ:value", F.col("status_value"))))))
    body = node("v1:CloseCustomerProblemRequest", F.concat(tef, data))
    return _root("soapenv:Envelope",
                 [("xmlns:soapenv", ns.soapenv), ("xmlns:typ", ns.typ), ("xmlns:v1", ns.v1)],
                 F.concat(F.lit("<soapenv:Header />"), node("soapenv:Body", body)))


# ---- jobs ---------------------------------------------------------------------

def cancel_job(messages: DataFrame, ns: CancelNamespaces = CancelNamespaces(), key: str = "file_name",
               require_ns: str | None = None, uris: dict[str, str] | None = None):
    """-> ``(rendered (key, xml), rejects (key, reason))``."""
    m = map_cancel(messages, require_ns=require_ns, uris=uris)
    ok = m.where("valid").select(key, render_cancel(m, ns).alias("xml"))
    bad = m.where(~F.col("valid")).select(key, "reason")
    return ok, bad


def close_job(messages: DataFrame, ns: CloseNamespaces = CloseNamespaces(), key: str = "file_name",
              require_ns: str | None = None, uris: dict[str, str] | None = None):
    m = map_close(messages, require_ns=require_ns, uris=uris)
    ok = m.where("valid").select(key, render_close(m, ns).alias("xml"))
    bad = m.where(~F.col("valid")).select(key, "reason")
    return ok, bad

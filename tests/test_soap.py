"""Cancel / close mapping on hand-written fixture messages (FIXTURES.md 7, 8).
Expected renderings are built independently with ElementTree."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tabkit.operators import soap

S = 'xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/"'
H = 'xmlns:head="urn:in:header"'
B = 'xmlns:body="urn:in:cancel"'


def _cancel(header: str, body: str) -> str:
    return f'<soapenv:Envelope {S} {H} {B}>{header}<soapenv:Body>{body}</soapenv:Body></soapenv:Envelope>'


def _hdr(**kw):
    vals = dict(country="PE", lang="es", entity="E1", system="SYS", subsystem="SUB", originator="O",
                userId="U1", operation="cancel", execId="X1", timestamp="2024-01-01T00:00:00")
    vals.update(kw)
    inner = "".join(f"<head:{k}>{v}</head:{k}>" if v is not None else "" for k, v in vals.items())
    return f"<head:HeaderIn>{inner}</head:HeaderIn>"


def _obj(inv, chars):
    cs = "".join(f"<body:Characteristic><body:name>{n}</body:name><body:value>{v}</body:value></body:Characteristic>"
                 for n, v in chars)
    return f"<body:RelatedObject><body:involvement>{inv}</body:involvement><body:describeByList>{cs}</body:describeByList></body:RelatedObject>"


def _req(objs_lists, date="2024-02-02", ext="EXT-1"):
    lists = "".join("<body:relatedObjectList>" + "".join(o) + "</body:relatedObjectList>" for o in objs_lists)
    return (f"<body:cancelTroubleTicketRequest><body:interactionDate>{date}</body:interactionDate>"
            f"<body:externalId>{ext}</body:externalId>{lists}</body:cancelTroubleTicketRequest>")


MESSAGES = {
    "all.xml": _cancel(f"<soapenv:Header>{_hdr(pid='P', msgId='M', msgType='T')}</soapenv:Header>",
                       _req([[_obj("owner", [("a", "1")])]])),
    "optional_missing.xml": _cancel(f"<soapenv:Header>{_hdr()}</soapenv:Header>", _req([[_obj("x", [])]])),
    "required_missing.xml": _cancel(f"<soapenv:Header>{_hdr(country=None)}</soapenv:Header>", _req([])),
    "required_empty.xml": _cancel(f"<soapenv:Header>{_hdr(country='')}</soapenv:Header>", _req([])),
    "no_header.xml": _cancel("", _req([])),
    "two_headers.xml": _cancel(f"<soapenv:Header>{_hdr(country='AA')}{_hdr(country='BB')}</soapenv:Header>", _req([])),
    "two_lists.xml": _cancel(f"<soapenv:Header>{_hdr()}</soapenv:Header>",
                             _req([[_obj("o1", [("n1", "v1")]), _obj("o2", [("n2", "v2")])],
                                   [_obj("o3", []), _obj("o4", [("n4", "v4"), ("n5", "v5")])]])),
    "special.xml": _cancel(f"<soapenv:Header>{_hdr(originator='a &amp; b &lt;c&gt; é ñ')}</soapenv:Header>",
                           _req([[_obj("déjà", [("k", "x &amp; y")])]])),
    "malformed.xml": "<soapenv:Envelope><soapenv:Header>",
    "char_missing.xml": _cancel(f"<soapenv:Header>{_hdr()}</soapenv:Header>",
                                "<body:cancelTroubleTicketRequest><body:interactionDate>d</body:interactionDate>"
                                "<body:externalId>e</body:externalId><body:relatedObjectList><body:RelatedObject>"
                                "<body:involvement>i</body:involvement><body:describeByList><body:Characteristic>"
                                "<body:name>n</body:name></body:Characteristic></body:describeByList>"
                                "</body:RelatedObject></body:relatedObjectList></body:cancelTroubleTicketRequest>"),
}


def _expected_cancel(doc: str, ns=soap.CancelNamespaces()) -> str:
    """Independent ElementTree mapping of one valid cancel message."""
    nsm = {"s": "http://schemas.xmlsoap.org/soap/envelope/", "h": "urn:in:header", "b": "urn:in:cancel"}
    root = ET.fromstring(doc)
    env = ET.Element("soapenv:Envelope", {"xmlns:soapenv": ns.soapenv, "xmlns:head": ns.head, "xmlns:v1": ns.v1})
    hdr = ET.SubElement(ET.SubElement(env, "soapenv:Header"), "head:HeaderIn")
    leaves = {f: ET.SubElement(hdr, f"head:{f}") for f in soap.HEADER_FIELDS}
    body = ET.SubElement(env, "soapenv:Body")
    req = ET.SubElement(body, "v1:cancelTroubleTicketRequest")
    idate = ET.SubElement(req, "v1:interactionDate")
    ET.SubElement(req, "v1:ID")
    ext = ET.SubElement(req, "v1:externalId")
    rol = ET.SubElement(req, "v1:relatedObjectList")
    for hi in root.findall("./s:Header/h:HeaderIn", nsm):
        for f in soap.HEADER_FIELDS:
            e = hi.find(f"h:{f}", nsm)
            leaves[f].text = ("" if e is None else e.text) if f in soap.HEADER_OPTIONAL else e.text
    for r in root.findall("./s:Body/b:cancelTroubleTicketRequest", nsm):
        idate.text = r.find("b:interactionDate", nsm).text
        ext.text = r.find("b:externalId", nsm).text
        for o in r.findall("./b:relatedObjectList/b:RelatedObject", nsm):
            ro = ET.SubElement(rol, "v1:RelatedObject")
            ET.SubElement(ro, "v1:involvement").text = o.find("b:involvement", nsm).text
            dl = ET.SubElement(ro, "v1:describeByList")
            for c in o.findall("./b:describeByList/b:Characteristic", nsm):
                ch = ET.SubElement(dl, "v1:Characteristic")
                ET.SubElement(ch, "v1:name").text = c.find("b:name", nsm).text
                ET.SubElement(ch, "v1:value").text = c.find("b:value", nsm).text
    return ET.tostring(env, encoding="us-ascii").decode("ascii").split("?>", 1)[-1].lstrip("\n")


@pytest.fixture(scope="module")
def cancel_out(spark):
    msgs = spark.createDataFrame(sorted(MESSAGES.items()), "file_name string, value string")
    ok, bad = soap.cancel_job(msgs)
    mapped = soap.map_cancel(msgs)
    return ({r.file_name: r.xml for r in ok.collect()}, {r.file_name: r.reason for r in bad.collect()},
            {r.file_name: r for r in mapped.collect()})


def test_cancel_rejects(cancel_out):
    ok, bad, _ = cancel_out
    assert set(bad) == {"required_missing.xml", "malformed.xml", "char_missing.xml"}
    assert bad["malformed.xml"] == "malformed XML"
    assert len(ok) == len(MESSAGES) - 3


@pytest.mark.parametrize("name", ["all.xml", "optional_missing.xml", "required_empty.xml", "no_header.xml",
                                  "two_headers.xml", "two_lists.xml", "special.xml"])
def test_cancel_render_matches_elementtree(cancel_out, name):
    ok, _, _ = cancel_out
    assert ok[name] == _expected_cancel(MESSAGES[name])


def test_cancel_mapped_fields(cancel_out):
    _, _, m = cancel_out
    assert m["two_headers.xml"].country == "BB"                      # last wins
    assert m["optional_missing.xml"].pid == ""                       # optional absent -> ''
    assert m["required_empty.xml"].country == "" and m["required_empty.xml"].valid
    assert m["no_header.xml"].country is None                        # container absent
    objs = m["two_lists.xml"].related
    assert [o.involvement for o in objs] == ["o1", "o2", "o3", "o4"]
    assert [len(o.characteristics) for o in objs] == [1, 1, 0, 2]
    assert m["special.xml"].originator == "a & b <c> é ñ"


CLOSE = ('<soapenv:Envelope xmlns:soapenv="http://schemas.xmlsoap.org/soap/envelope/" '
         'xmlns:typ="urn:in:types" xmlns:v1="urn:in:hdr"><soapenv:Header/><soapenv:Body>'
         '<typ:CloseCustomerProblemRequest><v1:TefHeaderReq><v1:userLogin>u</v1:userLogin>'
         '<v1:sessionCode>s</v1:sessionCode><v1:application>a</v1:application><v1:idMessage>i</v1:idMessage>'
         '<v1:transactionTimestamp>t</v1:transactionTimestamp></v1:TefHeaderReq>'
         '<typ:CloseCustomerProblemRequest_data><typ:problemReference><typ:id>42</typ:id></typ:problemReference>'
         '<typ:closeSummariesList><typ:problemSummary><typ:problemResolution><typ:code>R1</typ:code>'
         '</typ:problemResolution><typ:problemResolution><typ:code>R2</typ:code><typ:value>done</typ:value>'
         '</typ:problemResolution></typ:problemSummary></typ:closeSummariesList>'
         '<typ:problemStatus><typ:code>CLOSED</typ:code></typ:problemStatus>'
         '</typ:CloseCustomerProblemRequest_data></typ:CloseCustomerProblemRequest></soapenv:Body></soapenv:Envelope>')


def test_close_mapping(spark):
    msgs = spark.createDataFrame([("c1.xml", CLOSE), ("c2.xml", CLOSE.replace("<typ:id>42</typ:id>", "")),
                                  ("c3.xml", "<oops")], "file_name string, value string")
    m = {r.file_name: r for r in soap.map_close(msgs).collect()}
    r = m["c1.xml"]
    assert r.valid and r.userLogin == "u" and r.id == "42" and r.referenceNumber == ""
    assert (r.resolution_code, r.resolution_value) == ("R2", "done")      # last wins
    assert (r.status_code, r.status_value) == ("CLOSED", "")
    assert not m["c2.xml"].valid and not m["c3.xml"].valid
    ok, bad = soap.close_job(msgs)
    xml = ok.first().xml
    ns = soap.CloseNamespaces()
    assert xml.startswith(f'<soapenv:Envelope xmlns:soapenv="{ns.soapenv}" xmlns:typ="{ns.typ}" xmlns:v1="{ns.v1}">'
                          '<soapenv:Header /><soapenv:Body><v1:CloseCustomerProblemRequest><v1:TefHeaderReq>')
    assert "<typ:problemReference><typ:id>42</typ:id><typ:referenceNumber /></typ:problemReference>" in xml
    ET.fromstring(xml.replace("soapenv:", "").replace("typ:", "").replace("v1:", "")
                  .replace("xmlns:", "x-"))
    assert bad.count() == 2


def test_cancel_mapping_job_from_files(spark):
    import os
    import tempfile

    from tabkit import jobs
    root = tempfile.mkdtemp(prefix="tabkit-soap-")
    os.makedirs(f"{root}/in")
    for name in ["all.xml", "two_lists.xml", "malformed.xml", "special.xml"]:
        with open(f"{root}/in/{name}", "w", encoding="utf-8") as fh:
            fh.write(MESSAGES[name])
    ok, bad = jobs.cancel_mapping_job(spark, f"{root}/in", f"{root}/out", f"{root}/rej")
    out = {r.file_name: r.xml for r in spark.read.parquet(f"{root}/out").collect()}
    assert set(out) == {"all.xml", "two_lists.xml", "special.xml"}
    assert out["special.xml"] == _expected_cancel(MESSAGES["special.xml"])
    assert [r.file_name for r in spark.read.parquet(f"{root}/rej").collect()] == ["malformed.xml"]
    jobs.cancel_mapping_job(spark, f"{root}/in", f"{root}/out2", f"{root}/rej2", one_dir_per_name=True)
    with open([os.path.join(dp, f) for dp, _, fs in os.walk(f"{root}/out2/file_name=all.xml")
               for f in fs if f.endswith(".txt")][0]) as fh:
        assert fh.read().strip() == _expected_cancel(MESSAGES["all.xml"])


def test_strict_namespace(spark):
    msgs = spark.createDataFrame([("a.xml", MESSAGES["all.xml"])], "file_name string, value string")
    assert soap.map_cancel(msgs, require_ns="urn:in:cancel").first().valid
    r = soap.map_cancel(msgs, require_ns="urn:other").first()
    assert not r.valid and "namespace" in r.reason

"""Elements of messages matched by namespace URI."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tabkit.operators import soap

S, H, B = "urn:soap", "urn:h", "urn:b"
HEAD = "".join(f"<{{0}}{f}>{f}1</{{0}}{f}>" for f in soap.HEADER_FIELDS)
REQUEST = ("<{0}interactionDate>d</{0}interactionDate><{0}externalId>x&amp;y</{0}externalId><{0}relatedObjectList><{0}RelatedObject><{0}involvement>i</{0}involvement>"
           "<{0}describeByList><{0}Characteristic><{0}name>n</{0}name><{0}value><![CDATA[<b:value xmlns:b='urn:none'>]]></{0}value></{0}Characteristic></{0}describeByList></{0}RelatedObject></{0}relatedObjectList>")


def message(root, header, head, request, body):
    return f"<?xml version='1.0'?><s:Envelope xmlns:s='{S}' {root}><s:Header>{header.format(HEAD.format(head))}</s:Header><s:Body>{request.format(REQUEST.format(body))}</s:Body></s:Envelope>"


CASES = {
    "double": message(f'xmlns:h="{H}" xmlns:b="{B}"', "<h:HeaderIn>{}</h:HeaderIn>", "h:", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "b:"),
    "single": message(f"xmlns:h = '{H}'\n xmlns:b='{B}'", "<h:HeaderIn>{}</h:HeaderIn>", "h:", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "b:"),
    "other_prefix": message(f'xmlns:q="{H}" xmlns:h="{B}"', "<q:HeaderIn>{}</q:HeaderIn>", "q:", "<h:cancelTroubleTicketRequest>{}</h:cancelTroubleTicketRequest>", "h:"),
    "default": message("", f"<HeaderIn xmlns='{H}'>{{}}</HeaderIn>", "", f'<cancelTroubleTicketRequest xmlns="{B}">{{}}</cancelTroubleTicketRequest>', ""),
    "comment": message(f'xmlns:b="urn:no"><!-- xmlns:b="{B}" > <b:x xmlns:b="{B}"> --><x y="1"/', "", "", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "b:"),
    "in_attribute": message(f'''note='a > b xmlns:b="{B}"' xmlns:b="urn:no"''', "", "", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "b:"),
    "redeclared": message(f'xmlns:h="urn:no" xmlns:b="{B}"', f'<h:HeaderIn xmlns:h="{H}">{{}}</h:HeaderIn>', "h:", f"<b:cancelTroubleTicketRequest xmlns:b='urn:no'>{{}}</b:cancelTroubleTicketRequest><b:cancelTroubleTicketRequest>{REQUEST.format('b:')}</b:cancelTroubleTicketRequest>", "b:"),
    "decoy_last": message(f'xmlns:h="{H}" xmlns:b="{B}"', "<h:HeaderIn>{}</h:HeaderIn><HeaderIn><lang>no</lang></HeaderIn>", "h:", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "b:"),
    "foreign_leaf": message(f'xmlns:h="{H}" xmlns:b="{B}" xmlns:z="urn:z"', "<h:HeaderIn>{}</h:HeaderIn>", "h:", "<b:cancelTroubleTicketRequest>{}</b:cancelTroubleTicketRequest>", "z:"),
}


@pytest.fixture(scope="module")
def mapped(spark):
    rows = [*CASES.items(), ("null", None), ("empty", ""), ("broken", "<a><b")]
    df = spark.createDataFrame(rows, "file_name string, value string")
    return {r.file_name: r for r in soap.map_cancel(df, uris=soap.cancel_uris(S, H, B)).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_matches_elementtree(mapped, name):
    ns, root, got = {"s": S, "h": H, "b": B}, ET.fromstring(CASES[name]), mapped[name]
    headers, requests = root.findall("s:Header/h:HeaderIn", ns), root.findall("s:Body/b:cancelTroubleTicketRequest", ns)
    text = lambda e, f: None if e is None or e.find(f, ns) is None else e.find(f, ns).text
    last_h, last_r = (headers or [None])[-1], (requests or [None])[-1]
    lost = any(text(r, "b:interactionDate") is None for r in requests)
    assert got.valid == (not lost)
    assert got.lang == text(last_h, "h:lang") and got.interactionDate == text(last_r, "b:interactionDate") and got.externalId == text(last_r, "b:externalId")
    want = [[c.findtext("b:value", None, ns) for c in o.findall("b:describeByList/b:Characteristic", ns)] for r in requests for o in r.findall("b:relatedObjectList/b:RelatedObject", ns)]
    assert [[c.value for c in o.characteristics] for o in got.related] == want


def test_what_the_cases_hold(mapped):
    assert all(mapped[k].lang == "lang1" and mapped[k].externalId == "x&y" for k in ("double", "single", "other_prefix", "default", "redeclared", "decoy_last"))
    assert all(mapped[k].valid and mapped[k].externalId is None for k in ("comment", "in_attribute"))
    assert not mapped["foreign_leaf"].valid and not mapped["broken"].valid


def test_close_by_uri(spark):
    text = ("<s:Envelope xmlns:s='urn:soap' xmlns:v='urn:v' xmlns:t='urn:t'><s:Body><v:CloseCustomerProblemRequest><t:CloseCustomerProblemRequest_data>"
            "<t:problemReference><t:id>7</t:id></t:problemReference><v:problemReference><v:id>8</v:id></v:problemReference>"
            "</t:CloseCustomerProblemRequest_data></v:CloseCustomerProblemRequest></s:Body></s:Envelope>")
    df = spark.createDataFrame([("a", text)], "file_name string, value string")
    assert soap.map_close(df).first().id == "8"
    assert soap.map_close(df, uris=soap.close_uris("urn:soap", "urn:t", "urn:v")).first().id == "7"

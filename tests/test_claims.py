"""Two-key claims matching: FIXTURES.md 6 edge rows, catalogue cases, the
salted path, equality with the literal OR join, and plan shape."""

import pytest
from pyspark.sql import functions as F

from tabkit.operators import claims as C
from tabkit.plans.checks import plan_text


def _claims(spark, subs):
    rows = [(f"R{i}", "cli", s, "c", "cf", "cc", "id", "td", "nd", "seg") for i, s in enumerate(subs)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.CLAIM_COLUMNS))


def _calls(spark, pairs, code="1"):
    rows = [("20240101", "1200", "O", "60", o, d, code, "100", "S") for o, d in pairs]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.MOBILE_CALL_COLUMNS))
    return C.mobile_calls(raw)


CAT = [("1", "OPER ONE"), ("2", None), ("3", "A"), ("3", "B")]


def _cat(spark):
    return spark.createDataFrame(CAT, "CODE_OPER string, DESCRIPTION string")


def test_edge_rows(spark):
    claims = _claims(spark, ["1", "2"])
    calls = _calls(spark, [("1", "2"), ("2", "2"), (None, "1"), ("9", "1"), ("9", "8")])
    out = C.match_calls(claims, calls).select("SUSCRIPCION", "NUMERO_ORIGEN", "NUMERO_DESTINO").collect()
    got = sorted((r[0], r[1] or "", r[2]) for r in out)
    assert got == sorted([("1", "1", "2"), ("2", "1", "2"), ("2", "2", "2"), ("1", "", "1"), ("1", "9", "1")])


@pytest.mark.parametrize("broadcast_rows,hot_rows", [(2_000_000, 1_000_000), (0, 1), (0, 10**9)])
def test_paths_agree_with_literal_or(spark, broadcast_rows, hot_rows):
    claims = _claims(spark, ["1", "2", "007", "*55#", "3"])
    pairs = [("1", "2"), ("2", "2"), (None, "1"), ("9", "1"), ("9", "8"), ("07", "1"), ("*55#", "7"),
             (" 3 ", "3"), ("3", "3"), ("1", "1")] * 3
    calls = _calls(spark, pairs)
    ours = C.match_calls(claims, calls, broadcast_claims_rows=broadcast_rows, hot_rows=hot_rows, salt_buckets=4)
    lit = C.literal_or_join(claims, calls)
    cols = C.CLAIM_COLUMNS + C.CALL_COLUMNS
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(map(key, ours.select(cols).collect())) == sorted(map(key, lit.select(cols).collect()))


def test_catalogue_cases(spark):
    claims = _claims(spark, ["5"])
    raw = spark.createDataFrame(
        [("d", "h", "O", "1", "5", "6", code, "v", "S") for code in ["1", "2", "3", "9", None]],
        ", ".join(f"{c} string" for c in C.MOBILE_CALL_COLUMNS))
    out = C.claims_detail(claims, C.mobile_calls(raw), _cat(spark)).select("DESCRIPCION_OPERADORA").collect()
    got = sorted((r[0] or "<null>") for r in out)
    # 1 -> description; 2 -> matched with NULL description stays NULL; 3 twice; 9 -> raw code; NULL -> NULL
    assert got == sorted(["OPER ONE", "<null>", "A", "B", "9", "<null>"])


def test_detail_layout_and_filter(spark):
    claims = _claims(spark, ["5"])
    rows = [(" d ", "h", "O", "1", "5", "6", "1", "v", t) for t in [" S", "V ", "X", None]]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.MOBILE_CALL_COLUMNS))
    out = C.claims_detail(claims, C.mobile_calls(raw), _cat(spark))
    assert out.columns == C.DETAIL_COLUMNS
    got = out.collect()
    assert sorted(r.TIPO_TRAFICO for r in got) == ["S", "V"]
    assert {r.FECHA_INICIO_LLAMADA for r in got} == {"d"} and {r.TEMPLATEID for r in got} == {"NIFI"}


def test_fixed_direction_swap(spark):
    rows = [("2024-01-01", "t", d, "1", "TGT", "ORI", "1", "0", "u") for d in ["E", "S", None]]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in C.FIXED_CALL_COLUMNS))
    out = {r.TIPO_LLAMADA: (r.NUMERO_ORIGEN, r.NUMERO_DESTINO) for r in C.fixed_calls(raw).collect()}
    assert out == {"E": ("TGT", "ORI"), "S": ("ORI", "TGT"), None: ("ORI", "TGT")}


def test_plan_has_no_nested_loop(spark):
    from tabkit.plans import bind_claims as B
    from tests.conftest import SF001
    for q in (B.q_claims_detail_mobile, B.q_claims_detail_salted):
        txt = plan_text(q(spark, SF001))
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt
    flagship = plan_text(B.q_claims_detail_mobile(spark, SF001))
    assert "BroadcastHashJoin" in flagship
    lit = plan_text(C.literal_or_join(B.claims_from_supplier(spark, SF001),
                                      C.mobile_calls(B.mobile_raw_from_lineitem(spark, SF001))))
    assert "NestedLoopJoin" in lit or "CartesianProduct" in lit

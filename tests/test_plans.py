"""No registered query plans a nested-loop or Cartesian join (the two-key
match, one-row aggregates and point sets are all expressed without one)."""

import pytest

import __spark_entry__ as E
from tabkit.plans.checks import plan_text
from tests.conftest import SF001

CHEAP = [n for n in E.queries() if not any(k in n for k in (
    "kmeans", "cluster", "gap", "elbow", "silhouette", "hierarch", "distances", "landing", "named_days",
    "fixed_window"))]


@pytest.mark.parametrize("name", CHEAP)
def test_no_nested_loop_join(spark, name):
    txt = plan_text(E.queries()[name](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in txt and "CartesianProduct" not in txt

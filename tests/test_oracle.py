"""Every registered query with oracle SQL equals DuckDB on sf0.001
(row multiset after rounding, column names)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.oracle_check import compare

NAMES = sorted(E.oracle_sql())


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    line = compare(spark, duck, name, SF001)
    assert line.startswith("OK"), line


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "TEMPLATEID" and df.count() > 0

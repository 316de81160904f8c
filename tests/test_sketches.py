"""Sketched quantiles: the rank error, groups, empty and missing values."""

import bisect
import random

import pytest

from tabkit.operators import describe as D


@pytest.mark.parametrize("error", [0.05, 0.01, 0.001])
def test_rank_error(spark, error):
    rng = random.Random(4)
    xs = [rng.lognormvariate(0, 3) for _ in range(30_000)] + [1.0] * 5_000 + [float(i % 7) for i in range(5_000)]
    df = spark.createDataFrame([(i % 2, x) for i, x in enumerate(xs)], "g int, x double").repartition(7)
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    for keys in (None, ["g"]):
        for r in D.quantiles(df, "x", probs, keys, approx=error).collect():
            own = sorted(x for i, x in enumerate(xs) if keys is None or i % 2 == r.g)
            for p, v in zip(probs, r[len(keys or []):]):
                assert bisect.bisect_left(own, v) <= (p + error) * len(own) + 1 and bisect.bisect_right(own, v) >= (p - error) * len(own) - 1


def test_tables(spark):
    df = spark.createDataFrame([(float(i), None if i % 10 == 0 else i * 2, "t") for i in range(1, 101)], "a double, b long, c string").repartition(3)
    exact, sketched = ({r["column"]: r for r in D.summary_table(df, approx=e).collect()} for e in (None, 0.001))
    assert set(exact) == set(sketched) == {"a", "b"}
    for c, r in exact.items():
        s = sketched[c]
        assert (s["min"], s["max"], s["nulls"]) == (r["min"], r["max"], r["nulls"]) and s["mean"] == pytest.approx(r["mean"])
        assert all(abs(s[q] - r[q]) <= 2 for q in ("q1", "median", "q3"))
    d = {r["column"]: r for r in D.describe_table(df, ["b"], approx=0.01).collect()}["b"]
    assert d["count"] == 90 and d["p50"] == pytest.approx(101, abs=6)  # one rank off


def test_no_rows_and_bad_error(spark):
    empty = spark.createDataFrame([], "a double, b long")
    assert [tuple(r) for r in D.summary_table(empty, approx=0.01).orderBy("column").collect()] == [(c, None, None, None, None, None, None, 0) for c in "ab"]
    assert D.quantiles(empty, "a", [0.5], approx=0.01).collect()[0][0] is None
    with pytest.raises(ValueError):
        D.quantiles(empty, "a", [0.5], approx=0.0)


def test_one_pass(spark):
    """No exchange carries rows: one partial aggregate a task."""
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    plan = D.summary_table(df, approx=0.01)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and "Generate inline" in plan

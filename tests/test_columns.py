"""Python-semantics column functions against Python itself (brute force over
a grid of strings, lists and indices), and durations against timedelta."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from tabkit.functions import columns as X

WORDS = ["", "a", "ab", "hello", "ñandú é", "xyz123"]
IDX = [-7, -3, -1, 0, 1, 2, 5, 9, None]


def test_string_index_and_slice(spark):
    rows = [(w, i, j) for w in WORDS for i, j in itertools.product(IDX, IDX)]
    df = spark.createDataFrame(rows, "w string, i int, j int")
    out = df.select("w", "i", "j",
                    F.when(F.col("i").isNotNull(), X.char_at("w", F.col("i"))).alias("c"),
                    X.str_slice("w", F.col("i"), F.col("j")).alias("s")).collect()
    for r in out:
        if r.i is not None:
            try:
                expect = r.w[r.i]
            except IndexError:
                expect = None
            assert r.c == expect, (r.w, r.i)
    # slices with explicit Column bounds: NULL bound means "open end"
    for r in out:
        i = r.i
        j = r.j
        expect = r.w[i:j]
        if i is None or j is None:
            continue      # open ends are covered by the literal-None test below
        assert r.s == expect, (r.w, i, j)


def test_open_slices_and_arrays(spark):
    df = spark.createDataFrame([(w, w.split(" ") if w else []) for w in WORDS + ["a b c d e"]],
                               "w string, a array<string>")
    for lo, hi in [(None, 2), (-2, None), (None, 99), (1, None), (-9, 3)]:
        got = df.select("w", "a", X.str_slice("w", lo, hi).alias("s"), X.arr_slice("a", lo, hi).alias("t")).collect()
        for r in got:
            assert r.s == r.w[lo:hi] and r.t == r.a[lo:hi], (lo, hi, r.w)
    got = df.select("a", X.arr_get("a", -1).alias("last"), X.arr_set("a", 1, F.lit("Z")).alias("set"),
                    X.arr_replace_slice("a", 0, 2, F.array(F.lit("Q"))).alias("rep"),
                    X.arr_append("a", F.lit("end")).alias("app")).collect()
    for r in got:
        a = list(r.a)
        assert r.last == (a[-1] if a else None)
        b = list(a)
        if len(b) > 1:
            b[1] = "Z"
        assert r.set == b
        c = list(a)
        c[0:2] = ["Q"]
        assert r.rep == c and r.app == a + ["end"]


def test_py_mod_and_power(spark):
    rows = [(a, b) for a in range(-7, 8) for b in (-4, -3, 2, 5)]
    got = spark.createDataFrame(rows, "a int, b int").select(
        "a", "b", X.py_mod("a", "b").alias("m"), X.int_power("a", F.lit(2)).alias("p")).collect()
    for r in got:
        assert r.m == r.a % r.b and r.p == r.a ** 2


def test_seconds_to_hms_matches_timedelta(spark):
    secs = [0, 1, 59, 61, 3599, 3661, 36000, 86399, 86400, 90061, 172805, 999999, -1, -86401]
    got = spark.createDataFrame([(s,) for s in secs], "s long").select(
        "s", X.seconds_to_hms("s").alias("t")).collect()
    for r in got:
        assert r.t == str(dt.timedelta(seconds=r.s)).zfill(8), r.s

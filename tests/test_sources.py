"""Day-window scans (hive layout under delta* folders, name-encoded days,
missing days), delimited sinks and the landing-zone ingest."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.plans.checks import plan_text
from tabkit.sources import daywindow as W
from tabkit.sources.delimited import SourceSpec, all_text_schema, empty_table
from tabkit.streaming.landing import ingest_available, read_output


def test_months_back_and_days():
    assert W.months_back(dt.date(2024, 3, 31), 1) == dt.date(2024, 2, 29)
    days = W.window_days("2024-03-15", 1)
    assert days[0] == dt.date(2024, 2, 15) and days[-1] == dt.date(2024, 3, 15) and len(days) == 30


def test_hive_window_prunes_and_reads_delta_folders(spark):
    base = tempfile.mkdtemp(prefix="tabkit-hive-")
    for day in ["2024-01-01", "2024-02-10", "2024-03-15", "2024-03-16"]:
        for delta in ["delta_1", "delta_2"]:
            p = f"{base}/fecha_comunicacion={day}/{delta}"
            os.makedirs(p)
            with open(f"{p}/part.dat", "w") as fh:
                fh.write(f"a|{day}\nb|{day}\n")
    schema = all_text_schema(["x", "d", "fecha_comunicacion"])
    df = W.read_hive_window(spark, base, SourceSpec("csv", "|", False, schema), "fecha_comunicacion",
                            "2024-03-15", 2)
    assert sorted({r.fecha_comunicacion for r in df.collect()}) == ["2024-02-10", "2024-03-15"]
    assert df.count() == 8
    assert "PartitionFilters: [isnotnull(fecha_comunicacion" in plan_text(df)


def test_named_days_skip_missing(spark):
    base = tempfile.mkdtemp(prefix="tabkit-named-")
    for day in ["20240101", "20240103"]:
        os.makedirs(f"{base}/{day}/node1")
        with open(f"{base}/{day}/node1/x.DAT", "w") as fh:
            fh.write(f"{day}|1\n")
    schema = all_text_schema(["d", "v"])
    df, skipped = W.read_named_days(spark, lambda d: f"{base}/{d:%Y%m%d}/*/*.DAT",
                                    SourceSpec("csv", "|", False, schema), "2024-01-04", 0,
                                    day_column="file_day", day_regex=r"/(\d{8})/")
    assert df.count() == 0 and skipped.count() == 1     # window of one day: 2024-01-04 is missing
    df, skipped = W.read_named_days(spark, lambda d: f"{base}/{d:%Y%m%d}/*/*.DAT",
                                    SourceSpec("csv", "|", False, schema), "2024-02-01", 1,
                                    day_column="file_day", day_regex=r"/(\d{8})/")
    assert sorted(r.file_day for r in df.collect()) == ["20240101", "20240103"]
    assert skipped.count() == 30 and skipped.where(F.col("day") == dt.date(2024, 1, 2)).count() == 1


def test_empty_table_typed(spark):
    e = empty_table(spark, all_text_schema(["a", "b"]))
    assert e.count() == 0 and e.columns == ["a", "b"]


def test_landing_ingest_quarantine_and_idempotence(spark):
    root = tempfile.mkdtemp(prefix="tabkit-landing-")
    os.makedirs(f"{root}/input")
    with open(f"{root}/input/a.csv", "w") as fh:
        fh.write("id,slope\n1,+10%\n2,oops-not-a-number\n")
    with open(f"{root}/input/b.csv", "w") as fh:
        fh.write("id,slope\n3,-6%\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("slope", T.StringType())])
    schema_bad = T.StructType([T.StructField("id", T.LongType()), T.StructField("slope", T.DoubleType())])
    args = (f"{root}/input", schema_bad, f"{root}/out", f"{root}/invalid", f"{root}/ckpt")
    ingest_available(spark, *args, archive_dir=f"{root}/archive")
    ingest_available(spark, *args, archive_dir=f"{root}/archive")    # nothing new: no re-read
    good = read_output(spark, f"{root}/out")
    bad = read_output(spark, f"{root}/invalid")
    # every row is either ingested or quarantined, exactly once
    assert good.count() + bad.count() == 3
    assert schema.fieldNames() == ["id", "slope"]


def test_orc_round_trip_keeps_every_column_of_orders(spark):
    from tabkit.plans.bind_sources import staging
    from tabkit.sources.delimited import read_orc
    from tests.conftest import SF001
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    path = staging(spark, "orders-orc-whole")
    orders.write.mode("overwrite").orc(path)
    back = read_orc(spark, path)
    assert back.schema == orders.schema and "o_orderdate" in back.columns
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0

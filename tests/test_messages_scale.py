"""Messages are parsed once, rendered without repeating a leaf, and their files listed and read once."""

import os
import shutil

from pyspark.sql import functions as F

from tabkit import jobs
from tabkit.operators import soap
from tabkit.sinks.files import write_named_text

NAMES = ["1_0.xml", "a b.xml", "50%+x.xml", "007", "ünï:c=d.xml", None, "x/y[1]^'\"", "1_0.xml"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_close_render_names_a_leaf_a_few_times(spark):
    ok, _ = soap.close_job(spark.createDataFrame([("a", "<x/>")], "file_name string, value string"))
    plan = _plan(ok)
    assert plan.count("from_xml") == 1 and plan.count("<typ:value>") == 2  # of the resolution and of the status


def test_cancel_render_names_a_leaf_a_few_times(spark):
    ok, _ = soap.cancel_job(spark.createDataFrame([("a", "<x/>")], "file_name string, value string"))
    plan = _plan(ok)
    assert plan.count("from_xml") == 1 and plan.count("<v1:value>") == 1


def test_text_beyond_ascii(spark):
    texts = ["", "a", "é", "aé<b>&\U0001F600z\n中文", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(soap.xml_text(F.col("t")).alias("t")).collect()]
    assert got == ["", "a", "&#233;", "a&#233;&lt;b&gt;&amp;&#128512;z\n&#20013;&#25991;", None]


def test_many_tags_by_uri(spark):
    """The walk grows with the tags, not with their square."""
    n = 20_000
    text = "<r xmlns='urn:a' xmlns:b='urn:b'>" + "<b:x/>" * n + "<x/></r>"
    got = spark.createDataFrame([(text,)], "t string").select(soap.by_uri(F.col("t"), {"x": "urn:a"}).alias("t")).first().t
    assert got == text.replace("<b:x/>", "<_other.x/>")


def test_job_reads_its_files_once(spark, tmp_path):
    write_named_text(spark.createDataFrame([("a.xml", "<x/>"), ("b.xml", "<x>")], "n string, value string"), str(tmp_path / "in"), "n", "value", one_dir_per_name=True)
    ok, bad = jobs.cancel_mapping_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "rejects"), by_folder="n")
    shutil.rmtree(tmp_path / "in")
    assert [r.file_name for r in ok.collect()] == ["a.xml"] and [r.file_name for r in bad.collect()] == ["b.xml"]


def test_folders_as_spark_lays_them_out(spark, tmp_path):
    df = spark.createDataFrame([(n, f"<m>{n}</m>" if i % 3 else None) for i, n in enumerate(NAMES)], "n string, value string").repartition(3, "value").cache()
    write_named_text(df, str(tmp_path / "own"), "n", "value", one_dir_per_name=True)
    df.write.partitionBy("n").text(str(tmp_path / "spark"))

    def held(root):
        return sorted((d, sorted(line for f in files if not f.startswith((".", "_")) for line in open(os.path.join(at, f), encoding="utf-8").read().split("\n")))
                      for at, _, files in os.walk(root) for d in [os.path.relpath(at, root)] if d != ".")

    assert held(tmp_path / "own") == held(tmp_path / "spark")
    write_named_text(df.limit(1), str(tmp_path / "own"), "n", "value", one_dir_per_name=True)
    assert len([d for d in os.listdir(tmp_path / "own") if "=" in d]) == 1

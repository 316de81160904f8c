"""Messages read from files: the name from the file or from its folder."""

from pyspark.sql import functions as F

from tabkit.operators import soap
from tabkit.sinks.files import write_named_text


def test_names_of_message_folders_survive(spark, tmp_path):
    names = ["1_0.xml", "a b.xml", "50%+x.xml", "007", "ünï:c=d.xml"]
    df = spark.createDataFrame([(n, f"<m>{n}\n{n}</m>") for n in names], "file_name string, value string")
    write_named_text(df, str(tmp_path / "in"), "file_name", "value", one_dir_per_name=True)
    got = soap.read_messages(spark, str(tmp_path / "in"), by_folder="file_name").withColumn("value", F.rtrim(F.regexp_replace("value", "\n$", "")))
    assert sorted((r.file_name, r.value) for r in got.collect()) == sorted((n, f"<m>{n}\n{n}</m>") for n in names)


def test_names_of_message_files(spark, tmp_path):
    (tmp_path / "x.xml").write_text("<m/>")
    assert [tuple(r) for r in soap.read_messages(spark, str(tmp_path)).collect()] == [("x.xml", "<m/>")]

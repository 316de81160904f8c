"""A day window lists and reads its own folders only."""

from datetime import date

from pyspark.sql import types as T

from tabkit.sources.daywindow import read_hive_window
from tabkit.sources.delimited import SourceSpec

SPEC = SourceSpec("csv", "|", False, T.StructType([T.StructField("v", T.StringType()), T.StructField("day", T.StringType())]))


def test_only_the_days_of_the_window_are_listed(spark, tmp_path):
    for day in ("2024-01-14", "2024-01-15", "2024-02-15", "2024-02-16", "__HIVE_DEFAULT_PARTITION__"):
        folder = tmp_path / f"day={day}" / "delta1"
        folder.mkdir(parents=True)
        (folder / "a").write_text(day + "\n")
    df = read_hive_window(spark, str(tmp_path), SPEC, "day", date(2024, 2, 15), 1)
    assert sorted((r.v, r.day) for r in df.collect()) == [("2024-01-15", "2024-01-15"), ("2024-02-15", "2024-02-15")]
    assert len(df.inputFiles()) == 2
    none = read_hive_window(spark, str(tmp_path), SPEC, "day", date(2020, 2, 15), 1)
    assert none.count() == 0 and none.columns == ["v", "day"]
    assert read_hive_window(spark, str(tmp_path / "absent"), SPEC, "day", date(2024, 2, 15), 1).count() == 0

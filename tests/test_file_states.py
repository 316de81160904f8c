"""Whole-file ingestion: states, quarantine, and runs cut off between any two phases."""

import os

import pytest
from pyspark.sql import types as T

from tabkit.streaming import files as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


class Stopped(Exception):
    pass


def _stop(*args, **kw):
    raise Stopped


@pytest.fixture
def zone(tmp_path):
    d = {n: str(tmp_path / n) for n in ("landing", "out", "invalid", "archive", "manifest")}
    os.makedirs(f"{d['landing']}/sub")

    def put(name, *lines):
        with open(f"{d['landing']}/{name}", "w") as f:
            f.write("id,v\n" + "".join(x + "\n" for x in lines))

    put("good.csv", "1,1.5", "2,2.5")
    put("one bad+row's.csv", "3,3.5", "4,x")
    put("sub/50%.csv", "5,5.5")
    put("empty.csv")
    put("_writing.csv", "9,9")
    open(f"{d['landing']}/nothing.csv", "w").close()
    d["put"] = put
    return d


def _run(spark, z):
    return S.ingest_files(spark, z["landing"], SCHEMA, z["out"], z["invalid"], z["archive"], z["manifest"])


def _all(folder):
    return sorted(os.path.relpath(os.path.join(r, f), folder) for r, _, fs in os.walk(folder) for f in fs if not f.startswith("."))


def _assert_done(spark, z):
    assert {(r.name, r.state, r.n_rows, r.n_bad) for r in S.file_states(spark, z["manifest"]).collect()} == {
        ("good.csv", "archived", 2, 0), ("one bad+row's.csv", "quarantined", 2, 1), ("sub/50%.csv", "archived", 1, 0),
        ("empty.csv", "archived", 0, 0), ("nothing.csv", "archived", 0, 0)}
    assert _all(z["landing"]) == ["_writing.csv"]
    assert _all(z["invalid"]) == ["run=1/one bad+row's.csv"]
    assert _all(z["archive"]) == ["run=1/empty.csv", "run=1/good.csv", "run=1/nothing.csv", "run=1/sub/50%.csv"]
    assert sorted((r.id, r.v, r._source_file) for r in spark.read.parquet(z["out"]).collect()) == [
        (1, 1.5, "good.csv"), (2, 2.5, "good.csv"), (5, 5.5, "sub/50%.csv")]


def test_whole_files_are_archived_or_quarantined(spark, zone):
    assert _run(spark, zone) == 1
    _assert_done(spark, zone)
    assert _run(spark, zone) is None
    zone["put"]("good.csv", "7,7.5")                 # the same name again is a new file
    assert _run(spark, zone) == 2
    assert sorted(r.id for r in spark.read.parquet(zone["out"]).collect()) == [1, 2, 5, 7]
    assert _all(zone["archive"])[-1] == "run=2/good.csv"


def test_stopped_between_output_and_archive(spark, zone, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(S, "_move", _stop)
        with pytest.raises(Stopped):
            _run(spark, zone)
    assert {r.state for r in S.file_states(spark, zone["manifest"]).collect()} == {"valid", "invalid"}
    assert _run(spark, zone) is None                 # nothing new, the run is ended
    _assert_done(spark, zone)


def test_stopped_in_the_middle_of_the_moves(spark, zone, monkeypatch):
    moved = []
    real = S._Files.move

    def some(self, src, dst):
        if "/run=1/" in dst and "phase" not in dst:
            if len(moved) == 2:
                raise Stopped
            moved.append(dst)
        real(self, src, dst)

    with monkeypatch.context() as m:
        m.setattr(S._Files, "move", some)
        with pytest.raises(Stopped):
            _run(spark, zone)
    assert _run(spark, zone) is None
    _assert_done(spark, zone)


def test_stopped_before_the_check_is_recorded(spark, zone, monkeypatch):
    real = S._record

    def record(states, files, manifest, run, phase):
        if phase == 2:
            raise Stopped
        return real(states, files, manifest, run, phase)

    with monkeypatch.context() as m:
        m.setattr(S, "_record", record)
        with pytest.raises(Stopped):
            _run(spark, zone)
    zone["put"]("later.csv", "8,8.5")                # not a file of the run that was cut off
    assert _run(spark, zone) == 2
    states = {r.name: (r.run, r.state) for r in S.file_states(spark, zone["manifest"]).collect()}
    assert states["good.csv"] == (1, "archived") and states["later.csv"] == (2, "archived")
    assert sorted(r.id for r in spark.read.parquet(zone["out"]).collect()) == [1, 2, 5, 8]

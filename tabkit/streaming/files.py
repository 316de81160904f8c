"""Whole-file ingestion with a manifest of file states.

A run takes every file now in the landing folder through three phases, each
a table of the manifest, put in place by one rename::

    <manifest>/run=<n>/phase=1   seen         the run's files
    <manifest>/run=<n>/phase=2   valid | invalid, with row counts
    <manifest>/run=<n>/phase=3   archived | quarantined

Rows of valid files are written to ``<out>/run=<n>`` before phase 2; files
are moved to ``<archive>/run=<n>`` or, if any of their rows does not parse,
whole to ``<invalid>/run=<n>`` before phase 3, in the same run. The next call
first ends a run that was cut off: without phase 2 its output is written
again (same files, overwrite), without phase 3 the moves are completed; a
file that is already at its target is left there. So no file is taken twice
and none is lost, whenever a run stops. A folder holds one run at a time.

Names are paths relative to the landing folder, taken recursively; names
that begin with ``_`` or ``.`` are not taken. A file of the name of an earlier
one is a new file of a later run. Empty files are valid and have no rows.
Listing and moving are metadata operations of the driver, as in Spark's own
file source; rows are parsed once, by tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabkit.scratch import Scratch

CORRUPT = "_corrupt_record"
STATES = "name string, size long, state string, n_rows long, n_bad long"


class _Files:
    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def qualified(self, path: str) -> str:
        return self.fs.makeQualified(self.path(path)).toString()

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def names(self, path: str) -> list[tuple[str, int]]:
        """(relative name, size) of the files below a folder."""
        root, out = self.qualified(path) + "/", []
        if not self.exists(path):
            return out
        found = self.fs.listFiles(self.path(path), True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().toString()[len(root):]
            if not any(part[:1] in "_." for part in name.split("/")):
                out.append((name, f.getLen()))
        return sorted(out)

    def children(self, path: str) -> list[str]:
        return [c.getPath().getName() for c in self.fs.listStatus(self.path(path))] if self.exists(path) else []

    def move(self, src: str, dst: str) -> None:
        """Idempotent: a file already moved stays where it is."""
        if self.exists(src):
            self.fs.mkdirs(self.path(dst).getParent())
            if not self.fs.rename(self.path(src), self.path(dst)):
                raise OSError(f"could not move {src} to {dst}")
        elif not self.exists(dst):
            raise FileNotFoundError(f"{src} is neither in place nor at {dst}")


def _record(states: DataFrame, files: _Files, manifest: str, run: int, phase: int) -> DataFrame:
    """Writes a phase beside its place and renames it there."""
    spark, target = states.sparkSession, f"{manifest}/run={run}/phase={phase}"
    aside = f"{manifest}/_aside-{uuid.uuid4().hex}"
    states.write.parquet(aside)
    files.move(aside, target)
    return spark.read.schema(STATES).parquet(target)


def _last(files: _Files, manifest: str) -> tuple[int, int]:
    """The last run and its last phase (0, 3 before the first run)."""
    runs = [int(n[4:]) for n in files.children(manifest) if n.startswith("run=")]
    if not runs:
        return 0, 3
    run = max(runs)
    return run, max(int(n[6:]) for n in files.children(f"{manifest}/run={run}") if n.startswith("phase="))


def _parsed(spark: SparkSession, landing: str, names: list[str], schema: T.StructType, sep: str, header: bool) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(full).option("sep", sep).option("header", str(header).lower())
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv([f"{landing}/{n}" for n in names]))
    # paths come URL-encoded from the scan
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.withColumn("_file", path)


def _check(spark, files, landing, schema, out_dir, manifest, run, sep, header, transform) -> None:
    seen = spark.read.schema(STATES).parquet(f"{manifest}/run={run}/phase=1")
    names = [r["name"] for r in seen.select("name").collect()]      # names only, as listed
    s = Scratch(spark, "file-ingest")
    rows = s.table(_parsed(spark, landing, names, schema, sep, header), "rows")
    # the scheme and slashes before the path differ between file systems
    root = files.path(files.qualified(landing)).toUri().getPath()
    rows = rows.withColumn("name", F.expr("substring(_file, instr(_file, :root) + length(:root))".replace(":root", "'" + (root + "/").replace("\\", "\\\\").replace("'", "\\'") + "'")))
    counts = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"))
    checked = (seen.join(counts, "name", "left").select(
        "name", "size", F.when(F.coalesce("bad", F.lit(0)) > 0, "invalid").otherwise("valid").alias("state"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("bad", F.lit(0)).cast("long").alias("n_bad")))
    checked = s.table(checked, "checked")
    good = rows.join(checked.where("state = 'invalid'"), "name", "left_anti").drop(CORRUPT, "_file").withColumnRenamed("name", "_source_file")
    (transform(good) if transform else good).write.mode("overwrite").parquet(f"{out_dir}/run={run}")
    _record(checked, files, manifest, run, 2)
    s.drop("rows", "checked")


def _move(spark, files, landing, invalid_dir, archive_dir, manifest, run) -> None:
    checked = spark.read.schema(STATES).parquet(f"{manifest}/run={run}/phase=2")
    for r in checked.select("name", "state").collect():
        target = archive_dir if r["state"] == "valid" else invalid_dir
        files.move(f"{landing}/{r['name']}", f"{target}/run={run}/{r['name']}")
    done = checked.withColumn("state", F.when(F.col("state") == "valid", "archived").otherwise("quarantined"))
    _record(done.select("name", "size", "state", "n_rows", "n_bad"), files, manifest, run, 3)


def ingest_files(spark: SparkSession, landing: str, schema: T.StructType, out_dir: str, invalid_dir: str, archive_dir: str, manifest: str,
                 sep: str = ",", header: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None) -> int | None:
    """Ends a run that was cut off, then takes the files now in ``landing``;
    returns the run's number, or None if there was no file."""
    files = _Files(spark, landing)

    def proceed(run: int, phase: int) -> None:
        if phase < 2:
            _check(spark, files, landing, schema, out_dir, manifest, run, sep, header, transform)
        if phase < 3:
            _move(spark, files, landing, invalid_dir, archive_dir, manifest, run)

    run, phase = _last(files, manifest)
    proceed(run, phase)
    names = files.names(landing)
    if not names:
        return None
    seen = spark.createDataFrame([(n, size, "seen", None, None) for n, size in names], STATES)
    _record(seen, files, manifest, run + 1, 1)
    proceed(run + 1, 1)
    return run + 1


def file_states(spark: SparkSession, manifest: str) -> DataFrame:
    """``(run, name, size, state, n_rows, n_bad)``: the last state of every file taken so far."""
    rows = spark.read.schema(STATES + ", run int, phase int").parquet(manifest)
    last = rows.groupBy("run", "name").agg(F.max_by(F.struct("size", "state", "n_rows", "n_bad"), "phase").alias("s"))
    return last.select("run", "name", "s.*")

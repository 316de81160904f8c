"""File sinks.

The source jobs funnel every output through ``repartition(1)`` (one task
writes everything). Here the number of files is an opt-in argument; when it
is given we use ``repartition(n)`` (a shuffle boundary, so the upstream
stages keep their parallelism) rather than ``coalesce(n)``, which would pull
the whole upstream plan into n tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _shape(df: DataFrame, files: int | None) -> DataFrame:
    return df.repartition(files) if files else df


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True,
                    files: int | None = None, mode: str = "overwrite") -> None:
    (_shape(df, files).write.mode(mode)
     .option("sep", sep).option("header", str(header).lower()).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_named_text(df: DataFrame, path: str, name_col: str, text_col: str,
                     mode: str = "overwrite", one_dir_per_name: bool = False) -> None:
    """Rendered documents with their target name.

    Default: many documents per part file, name kept as a column (parquet).
    ``one_dir_per_name``: text output partitioned by the name, one folder per
    document (only for small batches: millions of tiny files hurt). Where the
    folder is a mounted one, the tasks write these files themselves: Hadoop's
    local file system starts a process for every file and folder it makes.
    """
    rows = df.select(name_col, text_col)
    if not one_dir_per_name:
        rows.write.mode(mode).parquet(path)
    elif mode == "overwrite" and (folder := _mounted(df.sparkSession, path)):
        _write_folders(rows, folder, name_col, text_col)
    else:
        # each task moves its own folders to their place; the driver would move all, one by one
        rows.write.mode(mode).partitionBy(name_col).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def _mounted(spark, path: str) -> str | None:
    """The path in the file system of the machines, None for another one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(p).toUri().getPath() if fs.getScheme() == "file" else None


def _write_folders(rows: DataFrame, folder: str, name_col: str, text_col: str) -> None:
    """As ``partitionBy(name_col).text(folder)`` lays them out: a line per row,
    a file per name and task. A file gets its name when it is whole, so an
    attempt that fails leaves none."""
    def write(batches):
        import itertools
        import os
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        task, n = TaskContext.get(), 0
        pairs = ((r[0], r[1]) for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for name, group in itertools.groupby(pairs, lambda r: r[0] or "__HIVE_DEFAULT_PARTITION__"):
            escaped = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", name)
            at = os.path.join(folder, f"{name_col}={escaped}")
            os.makedirs(at, exist_ok=True)
            with open(part := f"{at}/_{task.taskAttemptId()}", "w", encoding="utf-8", newline="") as f:
                for _, text in group:
                    f.write(f"{'' if text is None else text}\n")
                    n += 1
            os.replace(part, f"{at}/part-{task.partitionId():05d}.txt")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    spark = rows.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{folder}")
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.delete(target, True)
    fs.mkdirs(target)
    as_text = rows.select(F.col(name_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    as_text.sortWithinPartitions("name").mapInArrow(write, "n long").agg(F.sum("n")).collect()
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS")).close()


def archive_file(spark, src: str, dest_dir: str) -> str:
    """Move one processed input file into ``dest_dir`` (created if needed),
    replacing an earlier copy of the same name. Uses the Hadoop FileSystem of
    the path (HDFS, object stores, local), a metadata operation on the
    driver; no data passes through it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    s = Path(src)
    d = Path(dest_dir)
    fs = s.getFileSystem(conf)
    fs.mkdirs(d)
    target = Path(d, s.getName())
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(s, target):
        raise OSError(f"could not move {src} to {dest_dir}")
    return target.toString()

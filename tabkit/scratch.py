"""Scratch tables in the shared checkpoint folder.

``Scratch(spark)`` owns one fresh sub-folder of ``spark.checkpoint.dir``.
``table(df, name)`` writes ``df`` there as Parquet and reads it back, which
cuts the lineage in a place every executor can see: a lost executor costs
the tasks it was running, never the table. ``drop(name)`` removes a table
that is no longer needed; what is left is removed when the application
ends. With ``free_shuffles`` the shuffle files of a write go as soon as the
table is written, not when the driver next collects its garbage.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a purely local session (tests) may leave it unset; it then gets a
    folder of its own. Elsewhere an unset folder is an error, because a
    machine-local one would be invisible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
    folder = "file://" + tempfile.mkdtemp(prefix="tabkit-scratch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session is gone already: the folder's owner cleans it
        pass


class Scratch:
    def __init__(self, spark: SparkSession, label: str = "tables", free_shuffles: bool = False):
        self.spark = spark
        self.free_shuffles = free_shuffles
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(_remove_at_exit, spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        before = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true" if self.free_shuffles else before)
        try:
            df.write.mode("overwrite").parquet(self.path(name))
        finally:
            self.spark.conf.set(FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for n in names:
            remove(self.spark, self.path(n))

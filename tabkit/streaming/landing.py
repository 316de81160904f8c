"""Landing-zone ingestion (input -> processed, or -> invalid) as a
Structured Streaming file source run with ``trigger(availableNow=True)``.

* The checkpoint records which files were taken, so a restarted or repeated
  run never reads a file twice (replaces "move to processing").
* ``cleanSource=archive`` moves finished files to ``archive_dir``
  (replaces "move to processed"). Spark archives a file only after a later
  micro-batch commits, so after an ``availableNow`` run the newest files can
  still sit in the landing folder; the checkpoint already prevents re-reads.
* Rows that do not parse under the declared schema go to the ``invalid``
  output with their raw text and source file (row-level quarantine instead
  of moving the whole file).
* Each micro-batch writes to ``.../batch_id=<id>`` with overwrite, so a
  batch retried after a failure replaces its own output (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def ingest_available(spark: SparkSession, landing_dir: str, schema: T.StructType,
                     out_dir: str, invalid_dir: str, checkpoint: str,
                     archive_dir: str | None = None, sep: str = ",", header: bool = True,
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None):
    """Process every file now present in ``landing_dir`` and stop."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    reader = (spark.readStream.schema(full).option("sep", sep).option("header", str(header).lower())
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(landing_dir).withColumn("_source_file", F.col("_metadata.file_path"))

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        if transform is not None:
            good = transform(good)
        good.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
        (df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"), "_source_file")
         .write.mode("overwrite").parquet(f"{invalid_dir}/batch_id={batch_id}"))
        df.unpersist()

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_output(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Everything an ingest wrote so far (all batches)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)

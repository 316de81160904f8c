"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tabkit.scratch import shared_dir


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "tabkit") -> SparkSession:
    """Local session used by tests and the bench; library code never calls it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/object store) folder and is
    used as is. Where it is unset, a local session gets a scratch folder of
    its own, and on a cluster it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side owns the setting
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        configured = shared_dir(spark)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured

"""Session helpers: a local session for tests/bench and the checkpoint dir."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoints of finished loads are removed once no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``). Where it is
    unset, as in tests, a folder below the warehouse, which the driver and all
    executors share; never a machine-local temporary folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        conf = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(conf or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return sc.getCheckpointDir()

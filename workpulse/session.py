"""Session construction for tests, the bench and local runs.

Library functions never build a session themselves: they take the caller's
``SparkSession`` (or a DataFrame) and only read its settings.  This module is
the single place where local defaults are chosen.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "workpulse") -> SparkSession:
    """Local session with AQE on, UTC clock, UI off and Arrow transfer.

    ``spark.checkpoint.dir`` is only filled in when the cluster has not named a
    shared folder already (local runs and tests)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # generated methods above HotSpot's 8000-byte JIT limit would run
        # interpreted; let Spark split or fall back instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("WORKPULSE_DRIVER_MEMORY", "16g"))
    )
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings without the UI: Spark's event log in a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true") \
            .config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only when
    none is configured (never overrides a cluster setting)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="workpulse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()

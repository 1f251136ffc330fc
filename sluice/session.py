"""Session helpers: a local session for tests and the shared scratch root."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

DEFAULT_CHECKPOINT_DIR = "/tmp/sluice-checkpoints"
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"
_CONTEXT_FOLDER = re.compile(r"/[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}/?$")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
        # Call-site capture for error messages costs several JVM round trips per
        # column expression while a plan is built; jobs do not need it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Wide typed projections generate large per-row methods; let the JIT
        # compile them instead of interpreting them (set the same on clusters).
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``, or the application has set
    one on its context; only when there is none and Spark runs in this one
    process (tests, a laptop) do we set one of our own on the context.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not root and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError(f"spark.checkpoint.dir is not set; {sc.master} needs a folder that all executors share")
        sc.setCheckpointDir(root or DEFAULT_CHECKPOINT_DIR)
    # The context adds a folder of its own to what it was given: without it, a restart finds the same place.
    return (root or _CONTEXT_FOLDER.sub("", sc.getCheckpointDir())).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    return f"{ensure_checkpoint_dir(spark)}/sluice/{name}-{uuid.uuid4().hex[:12]}"

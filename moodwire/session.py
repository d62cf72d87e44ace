"""Session helpers: defaults for local runs, and the shared work folder.

Library code never creates its own session on a cluster; it takes the
caller's. ``local_session`` is for tests, the bench and examples.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "moodwire", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.worker.reuse", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session that names none gets a private folder only where all work runs in one process
    (master ``local`` or ``local[...]``); on a cluster executors could not see it, so that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="moodwire-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for tables a job writes."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/moodwire/{name}-{uuid.uuid4().hex[:12]}"

"""Spark session helpers for tests, the bench and the command line.

Library operators never build a session: they take DataFrames and return
DataFrames.  These helpers only exist for the entry points that need one.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "snapweave") -> SparkSession:
    """A local-mode session configured like the cluster jobs expect.

    AQE stays on (runtime coalescing and skew handling), the UI is off and
    the session time zone is pinned to UTC so epoch conversions are stable.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SNAPWEAVE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """True where driver and tasks share one process, hence one disk."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never replaced.  Only in local mode
    is a fresh scratch folder used when nothing is configured, and removed at
    exit; with any other master a missing setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: no SparkContext
        sc = None
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc is None or not is_local(sc.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="snapweave-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    spark.conf.set(CHECKPOINT_CONF, path)
    return path

"""Session helpers.

Library code never creates a session; jobs receive one.  ``local_session`` is
for tests and the bench only.  ``shared_dir`` returns the cluster-wide folder
named by ``spark.checkpoint.dir``; a private temporary folder is set only when
the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "ashgrid",
                  event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench; ``event_log_dir`` (a scratch
    folder) turns on Spark's event log for stage and task timings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> None:
    """Settings every job relies on (UTC day boundaries, AQE)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """Cluster-visible scratch root: ``spark.checkpoint.dir`` or the context's
    checkpoint dir.  When neither is set, a ``local[...]`` session (tests) gets
    a temp folder, registered as its checkpoint dir; on a cluster, where each
    executor would write to its own disk, this raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ashgrid-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder under the shared dir for one job's output."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_join(base: str, *parts: str) -> str:
    if "://" in base:
        return "/".join([base.rstrip("/"), *parts])
    return os.path.join(base, *parts)

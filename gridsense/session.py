"""Session settings and the shared work folder.

All event-time logic assumes the session time zone is UTC: day windows are
aligned to the epoch, and text timestamps are read as UTC wall-clock time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings every job wants; cluster-specific sizes (memory, executors) are
# left to the submitter.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files of finished streaming queries are removed once
    # unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "gridsense",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time and AQE on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC, as every job of the reference does."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and streaming checkpoints.

    It is the folder the cluster names in ``spark.checkpoint.dir`` (or one
    set by ``setCheckpointDir``). On a cluster without either this fails: a
    folder of the driver's machine would not be seen by the executors. A
    local session (tests, bench) has one machine only and gets a folder under
    its warehouse directory, registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("no shared work folder: set spark.checkpoint.dir to a folder that the driver "
                           "and all executors see")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    path = warehouse.rstrip("/") + "/_gridsense_work"
    if "://" not in path and not path.startswith("file:"):
        path = os.path.abspath(path)
    sc.setCheckpointDir(path)
    return path


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under :func:`work_dir` (never reused)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

"""SparkSession helpers.

The library never forces cluster settings on an existing session: it only
fills in what a local/test run needs when the setting is unset.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "hourwise", cores: int | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench (no UI, UTC, AQE on)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIR: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialized tables, stream checkpoints and saved
    models: the cluster's ``spark.checkpoint.dir``. On a ``local`` master with
    that setting unset (tests) a fresh scratch folder is set for this session; a cluster without it raises."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions expose no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        key = sc.applicationId
        configured = _LOCAL_DIR.setdefault(key, tempfile.mkdtemp(prefix="hourwise-ckpt-"))
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def shared_root(spark: SparkSession) -> str:
    """The shared folder itself, which outlives a session: what ``spark.checkpoint.dir`` names. (``ensure_checkpoint_dir`` gives
    each session a folder of its own below it.) On a ``local`` master without that setting, this session's folder."""
    ensure_checkpoint_dir(spark)
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def pin_utc(spark: SparkSession) -> None:
    """Timestamps in the test data are NTZ; pin the zone so any LTZ value that
    appears (date_trunc, window) renders the same everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Spark session set-up shared by jobs, tests and the bench.

All timestamps in the warehouse are ``TIMESTAMP_NTZ`` read as UTC wall-clock
time, so the session zone is pinned to UTC. ANSI mode is kept on (casts fail
loudly like PostgreSQL), adaptive execution re-plans joins and shuffle sizes
at run time, and skewed join partitions are split by AQE.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every query relies on; safe to set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one of our own only when unset.

    On a cluster the setting names a shared folder every executor can reach,
    and a missing setting is an error. In local mode (tests, a laptop) an unset
    folder falls back to ``fallback`` or a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not target:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by all executors")
        target = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def build_session(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition stays in
    the low hundreds of MB at the target scale; AQE coalesces small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)

"""Session helpers: the settings the plans rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans are designed for; a cluster's own values win where already set.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "varsift",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("VARSIFT_DRIVER_MEMORY", "8g")))
    for k, v in {**PLAN_SETTINGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder is set only where none is configured and the
    master is local (tests). On a cluster without the setting this is an error: executors could not see a
    folder of the driver's machine.

    On a client without a SparkContext (Spark Connect) the session's setting is used as it is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect clients have no SparkContext
        sc = None
    if sc is None:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="varsift-ckpt-")
    sc.setCheckpointDir(path)
    return path

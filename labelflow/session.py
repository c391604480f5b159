"""Session helpers.

Cluster settings (executor counts, shuffle partitions, the checkpoint folder)
belong to whoever launches the job; these helpers only fill in values that
are unset, which is what local runs and tests need.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local session needs; on a cluster they come from spark-submit.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of tables that are no longer referenced are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "labelflow") -> SparkSession:
    """A local[N] session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LABELFLOW_DRIVER_MEMORY", "8g")))
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def job_session(app_name: str = "labelflow") -> SparkSession:
    """The active session, or one with the launcher's own master and settings; sets neither."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName(app_name).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared (HDFS/S3/...) path and we only
    read it; unset, it raises there. Only a local master gets a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    path = tempfile.mkdtemp(prefix="labelflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"

"""Session helpers.

Library functions never create or reconfigure a session; they take the caller's.
``local_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library is designed around. AQE re-plans joins from measured sizes
# (broadcast only when the materialised side is below the threshold, sort-merge
# otherwise), splits skewed partitions and coalesces small shuffle outputs.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster (not applied by the library; the caller owns its session).
# Shuffles start with many partitions and AQE coalesces them to ~256 MB each, so a stage never
# holds more per task than fits in executor memory; skewed partitions over 4x the median and
# 512 MB are split; scans read ~256 MB per task.
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "channelwise",
                  event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CHANNELWISE_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if event_log_dir:  # stage/task timings without the UI: read with tools/stage_times.py
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is; if it is unset there, this
    raises. With a local master a fresh scratch folder is created and registered with the context.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no local SparkContext (e.g. Spark Connect): use the setting only
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share") from None
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="channelwise-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for intermediate tables and stream
    state (unique per call, so runs never see each other's state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/channelwise/{name}-{uuid.uuid4().hex}"

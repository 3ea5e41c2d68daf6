"""SparkSession construction and the few session settings every operator relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine needs for correct results (UTC day boundaries) and for skew-safe plans.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # allow AQE to split a hot user's partition even when it costs an extra shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume (idempotent, runtime-settable only)."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app_name: str = "cohortlens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings; the Spark UI stays off."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               # reliable checkpoints are deleted once their DataFrame is garbage collected
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a local master gets a
    scratch folder; on a cluster that raises, as executors do not share the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cohortlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()

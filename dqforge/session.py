"""Session helpers: a tuned builder for local runs, and the shared checkpoint folder.

On a cluster the session is created by the platform; we only *read* its settings.  The
shared folder for materialised intermediates is whatever ``spark.checkpoint.dir`` names;
a folder of our own is set only when that setting is missing (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle partitions at
# runtime, skew-join splits hot partitions, and timestamps never shift by zone.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster (hundreds of executors, ~100 TB inputs).  AQE coalesces
# the many initial shuffle partitions down to ~advisory size and splits skewed join partitions;
# broadcasts stay small and explicit broadcasts in this library are always size-checked.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def cluster_builder(app: str = "dqforge") -> SparkSession.Builder:
    """A builder with ``CLUSTER_CONF``; the master and resources come from the platform."""
    b = SparkSession.builder.appName(app)
    for k, v in CLUSTER_CONF.items():
        b = b.config(k, v)
    return b


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "dqforge") -> SparkSession:
    """A ``local[N]`` session for tests and the bench (never used on a cluster)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # analysis-time rule probes raise and catch AnalysisException; keep their traces out of the log
    spark.sparkContext.setLogLevel("FATAL")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when none is configured.

    The folder is read from the session (``spark.checkpoint.dir``, or a directory already set on
    the context).  Only when neither exists and the master is local (tests) a temporary folder
    is set on the context; a cluster session without a shared folder is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        ctx = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 — Spark Connect has no context; the server's setting applies
        if conf:
            return conf
        raise RuntimeError("no spark.checkpoint.dir configured for this (remote) session")
    if conf:
        if not ctx:
            spark.sparkContext.setCheckpointDir(conf)
        return conf
    if ctx:
        return ctx
    if not spark.sparkContext.master.startswith("local"):
        # a driver-local folder is invisible to executors: a cluster must name a shared one
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for this cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dqforge-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (visible to every executor)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/dqforge/{name}-{uuid.uuid4().hex[:12]}"

"""Spark session and shared-scratch helpers.

Nothing here is tuned for one machine: partition counts come from the
session (AQE coalesces them at runtime) and every scratch path lives under
the cluster-wide checkpoint directory the session names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, app: str = "perfmart",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the local bench.

    An active session (a cluster job's) is returned untouched: its partition
    counts, memory and checkpoint folder are the cluster's, not ours.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
        .config("spark.driver.memory", "8g")
    )
    event_dir = os.environ.get("PERFMART_EVENT_LOG")
    if event_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.compress", "false")
                   .config("spark.eventLog.dir", event_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory.  Only a local session that names
    none gets one on this machine (tests); on a cluster, executors would write
    to their own disks, so a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="perfmart-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory (never a
    machine-local temp folder on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/perfmart-{name}-{uuid.uuid4().hex[:12]}"


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders, in whatever store they are."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)

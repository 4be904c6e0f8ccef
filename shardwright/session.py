"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings for sessions this library creates (get_spark: bench, tests, CLI).
# Queries and jobs that receive a caller's session never change its settings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches of documents handed to the encoder (the reference hands
    # 8,192 documents to its encoder at once).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "8192",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shardwright") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Local mode runs everything in the driver JVM; size it (ignored when a
    # cluster launcher already started the JVM).
    builder = builder.config("spark.driver.memory", os.environ.get("SHARDWRIGHT_DRIVER_MEMORY", "12g"))
    ev = os.environ.get("SHARDWRIGHT_EVENT_LOG")
    if ev:  # profiling: stage and task times from the event log, no UI
        os.makedirs(ev, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as given; it must
    be set there. Only a local master (tests) without it gets a folder under the
    local temp directory.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shardwright-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shardwright`` importable in every Python worker (once per
    context): zip the package and hand it to ``addPyFile``."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="shardwright-py-"), "shardwright.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Round-robin a scan across the default parallelism when it arrived in
    fewer splits (e.g. a single-row-group file), so per-row encoding work is
    not serialised on one core. Large inputs already have at least that many
    splits and are returned unchanged (no extra shuffle)."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


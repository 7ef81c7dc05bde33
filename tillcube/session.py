"""Spark session and shared-storage helpers.

Jobs write intermediate tables (the warehouse, fragments, replicas) into
the shared folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (local tests) do we create a folder of our own.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; the driver's own session may differ
# and the operators do not depend on them for correctness.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Local mode runs every task in the driver JVM.
    "spark.driver.memory": "8g",
}


# Settings for a large cluster (100 TB of input, ~1000 executors).  The
# shuffle width is an upper bound that AQE coalesces down to ~256 MB
# partitions; scans are split at 256 MB, which keeps a task's working set
# well inside a few GB of executor memory; skewed partitions (> 5x median
# and > 512 MB) are split.  The broadcast threshold stays at Spark's
# default: dimensions above it are sort-merge joined.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tillcube", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with our defaults; ``cluster=True`` adds ``CLUSTER_CONF``
    (the driver memory setting only matters in local mode)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.pop("spark.driver.memory", None)
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir); only if neither is set, make a local one (tests).
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not root:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="tillcube-shared-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


# Partitions of a table that one task writes side by side before it sorts its rows by them.
OPEN_WRITERS = 32


@contextlib.contextmanager
def open_writers(spark: SparkSession, writers: int = OPEN_WRITERS):
    """While it lasts, a task that writes up to ``writers`` partitions of a
    table needs no sort by partition.  Results do not depend on it."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(name, None)
    spark.conf.set(name, str(writers))
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-before-used path for a table written by a job.

    Spark cannot overwrite a path that the same plan reads, so every write
    goes to a new directory.
    """
    return f"{shared_root(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"

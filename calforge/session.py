"""Session defaults and the shared working folder.

Cluster settings win: a key that the session already carries is never overwritten.
The shared folder for checkpoints and written intermediate tables is whatever the
cluster names in ``spark.checkpoint.dir``; only when it is unset (local tests) a
scratch folder is created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for scale; AQE re-plans shuffles and splits skewed join partitions
# at run time, so a hot key (a third of all rows) does not end up in one task.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Text stages are CPU-heavy per byte: after a small shuffle, let AQE keep a few
    # more partitions (parallelism first) instead of packing a stage into one task.
    # Large shuffles are unaffected (their partitions are far above this minimum).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # Page text shrinks to a tenth or less in shuffle files: a task that joins and sorts
    # 64 MB of them (the engine's own target) holds most of a gigabyte of rows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "calforge") -> SparkSession:
    """Return the active session (or build one for local runs) with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("CALFORGE_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    apply_defaults(spark, shuffle_partitions)
    return spark


def apply_defaults(spark: SparkSession, shuffle_partitions: int | None = None) -> None:
    explicit = spark.conf.getAll          # only what the cluster/session set explicitly
    for key, value in DEFAULT_CONF.items():
        if key not in explicit:
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    shared_dir(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written tables.

    Read from the SparkContext checkpoint dir (``spark.checkpoint.dir``). Only when it
    is unset, e.g. in local tests, a scratch folder is made and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="calforge-ckpt-")
        try:   # informational; some deployments reject core keys at run time
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001
            pass
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never machine-local on a cluster)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def stored_table(df, name: str):
    """Write ``df`` into the shared folder and read it back: its rows are computed once, and its
    lineage ends at files that every executor can reach."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df):
    """Spread the rows of a scan over ``spark.calforge.scanPartitions`` tasks, when the caller
    has set it: for small files of one or two row groups under heavy per-row work. Unset (the
    default, and right for large inputs) the scan stays as it is, without a shuffle."""
    wanted = df.sparkSession.conf.get("spark.calforge.scanPartitions", None)
    return df.repartition(int(wanted)) if wanted else df


def evenly(df, *cols):
    """Rows dealt by the hash of ``cols`` for heavy per-row text work. Stored pages and texts compress
    to a small part of their size, so scans by file size would give a few tasks most of the text; for
    the same reason the shuffle partitions are all kept, not put together by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)

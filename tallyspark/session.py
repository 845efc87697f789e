"""Spark session set-up and the shared folder used to cut lineage.

Everything here is configuration: AQE (runtime re-planning, partition
coalescing, skew-join splitting), UTC session time, Arrow for pandas
transfer.  Nothing is tuned for one data size; AQE sizes partitions from
runtime statistics.
"""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Streaming state (newest row per id, open windows) on local disk with
    # changelog checkpoints, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tallyspark",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


MB = 1 << 20


def cluster_settings(total_cores: int, largest_shuffle_bytes: int,
                     partition_bytes: int = 256 * MB) -> dict:
    """Shuffle and scan sizing for a large cluster.

    AQE can merge small shuffle partitions but only splits them for skewed
    joins, so the initial count must be fine enough for the largest shuffle:
    about ``partition_bytes`` each (at least three tasks per core), which
    AQE then coalesces toward the same advisory size.  Pass the result as
    ``conf`` to ``get_session`` (or ``spark-submit --conf``).
    """
    parts = max(total_cores * 3, math.ceil(largest_shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset and the master is local
    (tests) a folder of our own is created and registered; on a cluster a
    local folder is not shared, so that is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    sc.setCheckpointDir(root)
    return sc._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")

"""Session construction and shared storage locations.

The session follows the cluster's configuration: the master, the checkpoint
folder and the shuffle width are taken from the submitted configuration when it
is present, and only filled in when absent (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Streaming state settings. The retention count is the reference's value; the
# maintenance interval carries an explicit unit (a bare "300" means 300 ms).
STREAMING_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "10",
    "spark.sql.streaming.stateStore.maintenanceInterval": "300s",
}

BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for a large cluster (opt-in with ``profile="cluster"``): start
# with a wide shuffle and let AQE coalesce it to ~256 MB partitions, read
# scans in 512 MB splits, let AQE split skewed join partitions. Values in the
# submitted configuration win over these.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str = "tidewater",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    rocksdb_state: bool = False,
    extra: dict[str, str] | None = None,
    profile: str = "default",
) -> SparkSession:
    """Return a session; a cluster master is used when one is configured.

    ``master`` is only applied when the submitted configuration has none, so the
    same entry point runs under ``spark-submit`` and from a laptop.
    ``profile="cluster"`` adds ``CLUSTER_CONF`` for keys the submitted
    configuration does not set.
    """
    conf = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if not conf.contains("spark.master"):
        builder = builder.master(master or "local[*]")
    if profile not in ("default", "cluster"):
        raise ValueError("profile must be 'default' or 'cluster'")
    settings = {**BATCH_CONF, **STREAMING_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    settings = {k: v for k, v in settings.items() if not conf.contains(k)}
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb_state:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; when the setting is absent on a local master (tests)
    a private folder is created and registered as the checkpoint dir. On a
    cluster a missing setting is an error: a folder of one machine would lose
    what the others write.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover - conf lookups differ on Connect
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current
    if not root and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-existing path under the shared checkpoint folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/tidewater/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch paths; call it when no
    result that reads them is needed any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def local_dir(path: str) -> str | None:
    """Filesystem path for a ``file:`` URI or bare path, else ``None``."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in path:
        return None
    return os.path.abspath(path)

"""Spark session defaults and shared-storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpointed histograms / basket items are deleted once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "basketry", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with UTC time, AQE and the RocksDB state store.

    ``shuffle_partitions`` must be chosen before a streaming query's first
    checkpoint: stateful operators pin it for the life of the checkpoint.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is read, never replaced.
    Only when it is unset (local tests) a fresh local folder is created.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a "
                               "shared folder (HDFS/object store) that survives executor loss")
        root = tempfile.mkdtemp(prefix="basketry-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run's outputs."""
    root = checkpoint_root(spark)
    name = "-".join(p for p in parts if p) or "run"
    path = f"{root}/basketry/{name}-{uuid.uuid4().hex[:12]}"
    return path

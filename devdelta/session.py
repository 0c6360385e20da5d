"""Session helpers: a local session for tests and benchmarks, and the shared
checkpoint folder taken from the cluster configuration."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    # Local mode: the parse stages are CPU-bound on little data; coalescing the
    # 8 shuffle partitions by bytes would leave cores idle.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Recommended settings for large clusters, applied only where the cluster has
# not set them (``apply_cluster_defaults``).  Sizing rationale: the heavy work
# is JSON parsing before the first shuffle and sorting inside the windows after
# it, so input splits and post-shuffle partitions are kept near 256 MB; AQE
# coalesces small partitions and splits skewed join partitions at run time;
# stream state lives in RocksDB with changelog checkpointing (small, frequent
# checkpoints instead of full snapshots).
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_cluster_defaults(spark: SparkSession, input_bytes: int | None = None) -> dict[str, str]:
    """Set the recommended values that the session does not set yet.

    With ``input_bytes`` known, the shuffle partition count targets about
    256 MB per partition (it also fixes the state partitions of a new stream).
    Returns what was set.
    """
    applied = {}
    for k, v in CLUSTER_DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            applied[k] = v
    if input_bytes:
        n = max(spark.sparkContext.defaultParallelism, -(-input_bytes // (256 << 20)))
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        applied["spark.sql.shuffle.partitions"] = str(n)
    return applied


def local_session(cores: int | str = "*", app: str = "devdelta", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data and checkpoints.

    It is the one named by ``spark.checkpoint.dir``.  Where that is unset, a
    single-machine session (``local[...]``) uses its own warehouse folder; any
    other session gets an error, because a folder of the driver's machine would
    be invisible to the executors and lost with the driver.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """The name of a new folder below the shared root (Spark's writers create it)."""
    return f"{checkpoint_root(spark)}/devdelta/{name}-{uuid.uuid4().hex[:12]}"

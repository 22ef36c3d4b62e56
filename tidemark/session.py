"""Session helpers: defaults every plan relies on, and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the transforms assume. All are session-scoped SQL confs, so they can be
# applied to a session somebody else built (the driver's) without a restart.
SQL_DEFAULTS = {
    # Event times are wall-clock values without a zone; pin UTC so casts between
    # timestamp_ntz and timestamp (needed for watermarks) are the identity.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state: RocksDB (state larger than memory) with changelog checkpointing, so a
    # commit writes a small changelog instead of uploading state snapshots every batch.
    # Both are captured by a stateful query when it first starts.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def ensure_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, master and sizing come from spark-submit."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Lineage cuts, stream checkpoints and scratch tables live below it so that any executor
    (and a restarted driver) can reach them. Only on a local master without the setting, as in
    tests, is a private folder chosen; elsewhere a missing setting is an error, because a folder
    of the driver's machine is out of the executors' reach.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root (never reused, never a machine-local tmp)."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"

"""SparkSession defaults and the shared lineage-cut folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local run. On a cluster the deployment owns these settings; we only
# fill in what is unset.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast conversion is Spark's own size check: a join side is broadcast
    # only when its measured shuffle output is below this, otherwise it stays a
    # shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app_name: str = "ticklake",
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session; the defaults above fill in what is unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = builder.config("spark.ui.enabled", "false")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in LOCAL_DEFAULTS.items():
        # what the deployment or the caller has set stays
        if key not in (extra or {}) and not given.contains(key) and key.startswith("spark.sql."):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint dir for lineage cuts and scratch tables.

    The deployment names it in ``spark.checkpoint.dir``. Only when that is unset (local
    tests) do we create one and register it with the session.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ticklake-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    path = f"{base}/{name}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path

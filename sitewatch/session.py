"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. Event-time windows are cut on the
# epoch; with the session zone at UTC the TIMESTAMP <-> TIMESTAMP_NTZ casts used
# at the edges of the fixtures are identities.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# State of streaming queries: on disk beside the executor, checkpoints of changes only.
STATEFUL_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_state_store(spark: SparkSession) -> SparkSession:
    """Let queries started from now on keep their state in RocksDB. A query that was
    checkpointed with another store keeps that one."""
    for key, value in STATEFUL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (idempotent)."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app: str = "sitewatch",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; locally ``local[N]``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_RUNTIME_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("SITEWATCH_DRIVER_MEMORY", "8g"),
        # upserts checkpoint their merged rows every micro-batch; drop those
        # files once nothing references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for streaming checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster's shared location). Only
    when the session has none (local tests) a private temp folder is set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = getattr(spark.sparkContext, "_sitewatch_root", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(checkpoints on a machine-local folder do not survive "
                             "the loss of that machine)")
        root = tempfile.mkdtemp(prefix="sitewatch-ckpt-")
        # a running session does not let the setting be changed
        spark.sparkContext._sitewatch_root = root
    spark.sparkContext.setCheckpointDir(root)
    return root

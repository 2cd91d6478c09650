"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this library assumes. UTC pins `to_date` of offset
# timestamps; AQE re-plans joins/partition counts from runtime statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "presslake", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster the session already exists (spark-submit); only missing
    settings are filled in. ``spark.checkpoint.dir`` is taken from the
    cluster configuration and a scratch folder is used only when unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors need this state store; streams started from here on use it. It keeps one store a partition: changes
    are logged instead of uploading whole stores, and no disk is set aside ahead of need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


BATCH_BYTES = 4 << 20


def use_small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of ``BATCH_BYTES`` at most, in queries that start from here on. By number alone a batch
    holds 10,000 rows, however long they are, and a worker holds a batch several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` when the cluster names one; else, with a
    ``local[...]`` master only (tests), a scratch dir.

    On a cluster the setting must point at shared storage so reliable
    checkpoints survive the loss of any executor; without it this raises
    instead of silently using a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local"):
            # a machine-local folder is not shared storage: executors could
            # not read each other's checkpoint files
            raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name shared storage")
        conf_dir = tempfile.mkdtemp(prefix="presslake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir

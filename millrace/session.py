"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "millrace",
    master: str | None = None,
    time_zone: str = "Asia/Shanghai",
    shuffle_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Session for the jobs.

    Business timestamps arrive as text in UTC+8, so that is the default zone.
    ``shuffle_partitions`` is the upper bound that adaptive execution coalesces from
    (thousands on a cluster); for a stream it is the fixed number of state partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # splits the partition of a hot join key; also where that costs one more shuffle
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # recording the call site of every column triples the calls needed to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STORE)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (options or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="millrace-")
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")

"""Start streaming queries. A checkpoint location is always set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import ROCKSDB_STORE, checkpoint_root
from millrace.streaming.clock import TopicClock

# Memory outside the heap that all state of an executor shares.
STATE_MEMORY_MB = 1500


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for stateful streams, leaving the settings of the caller alone.

    The number of state partitions is fixed when a query first starts: choose it for the
    cluster, not for the first batch.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STORE)
    own.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    rocksdb = "spark.sql.streaming.stateStore.rocksdb"
    # counting the rows of the state costs a read for every write
    own.conf.set(f"{rocksdb}.trackTotalNumberOfRows", "false")
    # it is on disk twice: in the folders of the executors and in the checkpoint
    own.conf.set(f"{rocksdb}.compression", "zstd")
    # one limit for all, so that it does not grow with the number of state partitions
    own.conf.set(f"{rocksdb}.boundedMemoryUsage", "true")
    own.conf.set(f"{rocksdb}.maxMemoryUsageMB", str(STATE_MEMORY_MB))
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def start(
    df: DataFrame,
    name: str,
    write: Callable[[DataFrame, int], None],
    root: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` for every batch; ``every`` is the trigger interval,
    without it the query stops when all available input is done."""
    root = root or checkpoint_root(df.sparkSession)
    query = df.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", f"{root}/{name}/checkpoint")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return query.trigger(**trigger).start()


def run_to_folder(
    df: DataFrame, name: str, root: str, partition_by: list[str] | None = None, clock: TopicClock | None = None
) -> str:
    """Run all available input into a parquet folder, exactly once; returns the folder.

    ``clock`` is told the times of the topics that it has set watermarks on.
    """
    out = f"{root}/{name}/rows"
    writer = df.writeStream.queryName(name).format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = (
        writer.option("checkpointLocation", f"{root}/{name}/checkpoint").trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    if clock:
        clock.note_progress(query)
    return out


def to_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON text in a ``value`` column."""
    return df.select(F.to_json(F.struct("*")).alias("value"))

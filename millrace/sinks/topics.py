"""Topic sinks. A frame of ``value`` text goes to one topic; with a ``topic`` column each
row goes to its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def kafka_sink(messages: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> StreamingQuery:
    """Start a stream into a topic, or into the topic of each row when none is given.

    Delivery is at least once; readers that need more drop repeats by key.
    """
    columns = ["value"] if topic else ["topic", "value"]
    writer = messages.select(*columns).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def kafka_writer(servers: str, topic: str | None = None) -> Callable[[DataFrame, int], None]:
    """The same for use in ``foreachBatch``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        columns = ["value"] if topic else ["topic", "value"]
        writer = batch.select(*columns).write.format("kafka").option("kafka.bootstrap.servers", servers)
        (writer.option("topic", topic) if topic else writer).save()

    return write


def topic_folders_writer(path: str, topic: str | None = None) -> Callable[[DataFrame, int], None]:
    """Topics as folders of text, one per topic and batch; a batch run again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if topic:
            batch.select("value").write.mode("overwrite").text(f"{path}/{topic}/batch={batch_id}")
        else:
            rows = batch.select("topic", "value").write.mode("overwrite").partitionBy("topic")
            rows.text(f"{path}/by_topic/batch={batch_id}")

    return write

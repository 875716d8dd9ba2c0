"""Topics as frames of text, and as typed views for SQL.

The jobs only see a frame with a ``value`` column, so any reader will do: Kafka on a
cluster (its connector package must be on the class path), files in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.once import once


def kafka_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["groupIdPrefix"] = group
    return options


def kafka_text(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    start: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A topic as a stream of ``value`` text with its ``partition`` and ``offset``."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, group, start))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_text(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files as a stream of ``value`` lines."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def json_view(raw: DataFrame, name: str, schema: str, event_time: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """Register JSON text as a typed view.

    ``event_time`` is SQL over its columns giving the ``rowtime`` column; with a watermark
    ``delay`` behind it.
    """
    rows = raw.select(once(F.from_json("value", schema)).alias("row")).where("row IS NOT NULL").select("row.*")
    if event_time:
        rows = rows.withColumn("rowtime", F.expr(event_time))
        if raw.isStreaming:
            rows = rows.withWatermark("rowtime", delay)
    rows.createOrReplaceTempView(name)
    return rows

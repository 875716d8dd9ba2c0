"""Late and repeated rows of a topic, told apart before the jobs that count.

Spark drops what is behind a watermark without a trace, and counts what a source sends
again. Here every row of a batch gets a verdict, so that what is counted, what came too
late and what was sent before add up to what came in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.sinks.keyed import BUCKET, BucketedTable, bucket_of
from millrace.streaming.run import start

ON_TIME, LATE, REPEATED = "on_time", "late", "repeated"


class Admission:
    """The rows of a topic by key, for as long as they are not behind ``delay``.

    A row is late if it has no time, or one more than ``delay`` before the latest time that
    earlier batches had. Of other rows with the same ``keys`` the first counts, all others are
    repeated. A batch that is run again gets the same verdicts.
    """

    SCHEMA = StructType().add("key", "string").add("ms", "long").add("batch", "long")

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], delay: str, time: str = "event_time"):
        self.table = BucketedTable(spark, path)
        self.keys = list(keys)
        self.delay_ms = int(pd.Timedelta(delay).total_seconds() * 1000)
        self.time = time

    def judge(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch with ``admission``: ``on_time``, ``late`` or ``repeated``."""
        number = self.table.create()["number_of_buckets"]
        manifest = self.table.manifest()
        before = manifest.get("before" if manifest.get("batch") == batch_id else "newest")
        key = F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"})
        told = rows.select("*", key.alias("_key"), F.unix_millis(self.time).alias("_ms"))
        told = told.withColumn(BUCKET, bucket_of(F.col("_key"), number)).persist()
        try:
            newest = max((ms for ms in (before, told.agg(F.max("_ms")).first()[0]) if ms is not None), default=None)
            limit = None if before is None else before - self.delay_ms
            late = F.col("_ms").isNull() if limit is None else F.col("_ms").isNull() | (F.col("_ms") < limit)
            # at most one row per bucket
            buckets = sorted(r[BUCKET] for r in told.where(~late).select(BUCKET).distinct().collect())
            known = self.table.read(self.SCHEMA, buckets, rows.sparkSession).where(F.col("batch") != batch_id)
            known = known.select(F.col("key").alias("_seen")).distinct()
            first = Window.partitionBy("_key", late).orderBy("_ms", F.xxhash64("_key"))
            judged = told.withColumn("_nth", F.row_number().over(first)).join(known, F.col("_key") == F.col("_seen"), "left")
            again = (F.col("_nth") > 1) | F.col("_seen").isNotNull()
            judged = judged.withColumn("admission", F.when(late, LATE).when(again, REPEATED).otherwise(ON_TIME))
            fresh = judged.where(F.col("admission") == ON_TIME).select(
                F.col("_key").alias("key"), F.col("_ms").alias("ms"), F.lit(batch_id).cast("long").alias("batch"), BUCKET
            )
            due = self.table.append(fresh, batch=batch_id, before=before, newest=newest)
            if due:
                # what is behind the delay now is late whenever it comes again
                kept = self.table.read(self.SCHEMA, due)
                kept = kept if limit is None else kept.where(F.col("ms") >= limit)
                self.table.replace(kept.withColumn(BUCKET, bucket_of(F.col("key"), number)), due)
        finally:
            told.unpersist()
        return judged.select(*rows.columns, "admission")


def start_admission(
    rows: DataFrame,
    admission: Admission,
    writer: Callable[[str], Callable[[DataFrame, int], None]],
    name: str,
    root: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Write the rows of a topic to three outputs: ``writer`` gives the writer of each verdict.

    Counting jobs read the output ``on_time`` in place of the topic.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = admission.judge(batch, batch_id).persist()
        try:
            for verdict in (ON_TIME, LATE, REPEATED):
                writer(verdict)(judged.where(F.col("admission") == verdict).drop("admission"), batch_id)
        finally:
            judged.unpersist()

    return start(rows, name, write, root, every)

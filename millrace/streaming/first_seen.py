"""What devices did first, remembered between the batches of a stream in tables by device.

A batch is reduced to one row per key before its shuffle, so a device with a large part of
all rows is spread over the tasks, and joined with what is known. No row goes through
Python, and no state is held between batches but the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import times
from millrace.operators.joins import broadcast_if_small
from millrace.operators.logs import with_repaired_flag
from millrace.operators.visits import first_visits, visit_day
from millrace.sinks.keyed import BUCKET, BucketedTable, bucket_of


def _touched(keys: DataFrame) -> list[int]:
    """The buckets that a batch has keys in: at most as many rows as there are buckets."""
    return sorted(r[BUCKET] for r in keys.select(BUCKET).distinct().collect())


class FirstDays:
    """The first day on which each device claimed to be new, without expiry.

    It is the earliest in the first batch that holds the device. A batch that is run again
    finds its own days and gives the same rows.
    """

    SCHEMA = StructType().add("mid", "string").add("first_day", "date")

    def __init__(self, spark: SparkSession, path: str):
        self.table = BucketedTable(spark, path)

    def repair(self, logs: DataFrame, batch_id: int = 0) -> DataFrame:
        """``operators.logs.repair_new_visitors`` for one batch, given what was seen before."""
        number = self.table.create()["number_of_buckets"]
        claims = logs.where("is_new = '1' AND mid IS NOT NULL").groupBy("mid").agg(
            F.to_date(times.millis_to_time(F.min("ts"))).alias("first_day")
        )
        claims = claims.withColumn(BUCKET, bucket_of(F.col("mid"), number)).persist()
        try:
            buckets = _touched(claims)
            known = self.table.read(self.SCHEMA, buckets, logs.sparkSession)
            fresh = claims.join(known, "mid", "left_anti")
            if buckets and not fresh.isEmpty():
                due = self.table.append(fresh.select(*self.SCHEMA.fieldNames(), BUCKET))
                if due:
                    rows = self.table.read(self.SCHEMA, due).groupBy("mid").agg(F.min("first_day").alias("first_day"))
                    self.table.replace(rows.withColumn(BUCKET, bucket_of(F.col("mid"), number)), due)
        finally:
            claims.unpersist()
        first = self.table.read(self.SCHEMA, buckets, logs.sparkSession)
        return with_repaired_flag(logs, broadcast_if_small(first.withColumnRenamed("first_day", "_first_day")))


class DailyVisits:
    """The devices seen on each of the last days.

    A day is remembered until a batch brings rows that are more than ``memory_days`` later;
    in batches after that, rows of the day are late and dropped. A batch that is run again
    emits its own rows again.
    """

    SCHEMA = StructType().add("mid", "string").add("day", "date").add("batch", "long")

    def __init__(self, spark: SparkSession, path: str, memory_days: int = 1):
        self.table = BucketedTable(spark, path)
        self.memory_days = memory_days

    def first(self, pages: DataFrame, batch_id: int, ties: Sequence[str] = ()) -> DataFrame:
        """The first session entry per device and date that no earlier batch has emitted."""
        number = self.table.create()["number_of_buckets"]
        entries = first_visits(pages, ties).withColumn("day", visit_day())
        # rows without a device are one device
        entries = entries.withColumn(BUCKET, bucket_of(F.struct("mid", "day"), number)).persist()
        try:
            manifest = self.table.manifest()
            # what counts are the days before this batch, also when it is run again
            before = manifest.get("before" if manifest.get("batch") == batch_id else "newest")
            newest = max(filter(None, (before, entries.agg(F.max("day").cast("string")).first()[0])), default=None)
            told = {"batch": batch_id, "before": before, "newest": newest}
            oldest = F.date_sub(F.coalesce(F.lit(before).cast("date"), F.lit("0001-01-02").cast("date")), self.memory_days)
            wanted = entries.where((F.col("day") >= oldest) | F.col("day").isNull())
            buckets = _touched(wanted)
            known = self.table.read(self.SCHEMA, buckets, pages.sparkSession).where(F.col("batch") != batch_id)
            seen = known.select(F.col("mid").alias("_mid"), F.col("day").alias("_day"))
            same = F.col("mid").eqNullSafe(F.col("_mid")) & F.col("day").eqNullSafe(F.col("_day"))
            # the files of this version stay for the caller, who reads the rows again
            new = wanted.join(seen, same, "left_anti")
            if not new.isEmpty():
                keys = new.select("mid", "day", F.lit(batch_id).cast("long").alias("batch"), BUCKET)
                due = self.table.append(keys, **told)
                if due:
                    rows = self.table.read(self.SCHEMA, due).where((F.col("day") >= oldest) | F.col("day").isNull())
                    rows = rows.groupBy("mid", "day").agg(F.min("batch").alias("batch"))
                    self.table.replace(rows.withColumn(BUCKET, bucket_of(F.struct("mid", "day"), number)), due)
        finally:
            entries.unpersist()
        return new.select(*pages.columns)

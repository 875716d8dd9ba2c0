"""Joins of two topics in an interval of event time, batch by batch, with the rows that wait in tables.

A batch is joined as tables are: with itself, and with the rows of earlier batches that wait. The
watermark bounds what waits, as it does the state of a join of streams. But no row is kept on its
own with versions of its key: on disk are the rows of one batch, and twice the rows that wait.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sinks.keyed import SmallFiles

SIDES = ("left", "right")

Operator = Callable[[DataFrame, DataFrame], DataFrame]


class IntervalBatches:
    """Rows of two topics that may still meet rows of later batches.

    Rows meet where the right ``event_time`` is in ``[left event_time - before, left event_time
    + after]``. The watermark lies ``delay`` behind the slower topic; rows at or before the one
    that held when their batch came are late and dropped. A batch that is run again finds what
    waited before it and gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, before: str, after: str, delay: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.before, self.after = (F.expr(f"INTERVAL {i}") for i in (before, after))
        self.delay = int(pd.Timedelta(delay).total_seconds() * 1000)
        self.files = SmallFiles(spark, path)

    @staticmethod
    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        """The two topics as one stream, a row of one beside nothing of the other."""
        nothing = F.lit(None)
        return left.select(F.struct("*").alias("left"), nothing.cast(right.schema).alias("right")).unionByName(
            right.select(nothing.cast(left.schema).alias("left"), F.struct("*").alias("right"))
        )

    def join(self, batch: DataFrame, batch_id: int, operator: Operator) -> DataFrame:
        """``operator`` over all pairs of a left and a right row of which one is new in this batch.

        It is called with the new rows and with those that wait. What it returns reads files that
        stay until ``done``.
        """
        batch.write.mode("overwrite").parquet(self._rows("arrived", batch_id))
        new = self._read("arrived", batch_id, batch.schema)
        earlier = max((n for n in self._batches("seen") if n < batch_id), default=None)
        known = {} if earlier is None else json.loads(self.files.read(f"seen/{earlier:012d}.json"))
        newest = new.agg(*[F.max(F.unix_millis(f"{side}.event_time")).alias(side) for side in SIDES]).first()
        highest = {s: max((ms for ms in (known.get(s), newest[s]) if ms is not None), default=None) for s in SIDES}

        at, late, passed = F.coalesce("left.event_time", "right.event_time"), self._watermark(known), self._watermark(highest)
        on_time = new.where(at.isNotNull() if late is None else at > late)
        old = None if earlier is None else self._read("waiting", earlier, batch.schema)
        waiting = on_time if old is None else on_time.unionByName(old)
        if passed is not None:
            left, right = (F.col(f"{side}.event_time") for side in SIDES)
            waiting = waiting.where((left + self.after >= passed) | (right >= passed - self.before))
        waiting.write.mode("overwrite").parquet(self._rows("waiting", batch_id))
        self.files.write(f"seen/{batch_id:012d}.json", json.dumps(highest).encode())

        found = operator(self._side(on_time, "left"), self._side(on_time, "right"))
        if old is not None:
            found = found.unionByName(operator(self._side(on_time, "left"), self._side(old, "right")))
            found = found.unionByName(operator(self._side(old, "left"), self._side(on_time, "right")))
        return found

    def done(self, batch_id: int) -> None:
        """The result is written: remove the rows that neither this batch, run again, nor a later one reads."""
        for name in self.files.names("arrived"):
            self.files.delete(f"arrived/{name}")
        for kind, ending in (("waiting", ""), ("seen", ".json")):
            for n in [n for n in self._batches(kind) if n < batch_id][:-1]:
                self.files.delete(f"{kind}/{n:012d}{ending}")

    def _watermark(self, highest: dict[str, int | None]) -> Column | None:
        times = [highest.get(side) for side in SIDES]
        return None if None in times else F.timestamp_millis(F.lit(min(times) - self.delay))

    @staticmethod
    def _side(rows: DataFrame, side: str) -> DataFrame:
        return rows.where(F.col(side).isNotNull()).select(f"{side}.*")

    def _rows(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/{batch_id:012d}"

    def _read(self, kind: str, batch_id: int, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._rows(kind, batch_id))

    def _batches(self, kind: str) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(kind) if "-draft-" not in n]

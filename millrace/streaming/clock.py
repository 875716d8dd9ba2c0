"""Watermarks of several topics over restarts.

Where a job unites topics, each has its own watermark and the slowest counts. Spark keeps
only the common one over a restart: until a topic has new rows it counts as if it had none
yet, and holds all results back. Here the highest time of every topic is kept beside the
checkpoint and sent into the topic again, as a row without content, when the job starts.
A row of that kind also moves on a topic that is idle for long.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.sinks.keyed import SmallFiles

_CLOCK = "_clock"


class TopicClock:
    """The highest event time seen of each topic of one job, in a folder of the job."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.files = SmallFiles(spark, path)

    # what was seen

    def highest(self) -> dict[str, int]:
        """Milliseconds by topic."""
        names = [n for n in self.files.names("seen") if n.endswith(".json")]
        return json.loads(self.files.read(f"seen/{names[-1]}")) if names else {}

    def note(self, seen: dict[str, int]) -> None:
        """Enter the times that a batch has seen; the last few files stay."""
        known = self.highest()
        later = {t: ms for t, ms in seen.items() if ms is not None and ms > known.get(t, -(1 << 62))}
        if not later:
            return
        names = [n for n in self.files.names("seen") if n.endswith(".json")]
        number = int(names[-1].removesuffix(".json")) + 1 if names else 0
        self.files.write(f"seen/{number:012d}.json", json.dumps(known | later).encode())
        for name in names[:-2]:
            self.files.delete(f"seen/{name}")

    def note_progress(self, query: StreamingQuery) -> None:
        """Enter what the batches of a query have told; its listener does so batch by batch."""
        for progress in query.recentProgress:
            self._enter(progress["observedMetrics"] if isinstance(progress, dict) else progress.observedMetrics)

    def _enter(self, metrics) -> None:
        self.note({name.removeprefix("seen_"): row["ms"] for name, row in (metrics or {}).items() if name.startswith("seen_")})

    def listener(self, name: str) -> StreamingQueryListener:
        """To be added to the session before the query of this name starts."""
        clock = self

        class Noting(StreamingQueryListener):
            def onQueryStarted(self, event) -> None:
                pass

            def onQueryProgress(self, event) -> None:
                if event.progress.name == name:
                    clock._enter(event.progress.observedMetrics)

            def onQueryIdle(self, event) -> None:
                pass

            def onQueryTerminated(self, event) -> None:
                pass

        return Noting()

    # what is sent

    def tick(self, topic: str, ms: int) -> None:
        """A row without content at this time."""
        self.files.write(f"topics/{topic}/{uuid.uuid4().hex}.json", json.dumps({"ms": ms}).encode())

    def start(self, topics: Iterable[str]) -> None:
        """Before a job starts: every topic goes on from the highest time it had."""
        known = self.highest()
        for topic in topics:
            if not self.files.names(f"topics/{topic}"):
                self.files.write(f"topics/{topic}/empty.json", b"")  # a folder to read
            if topic in known:
                self.tick(topic, known[topic])

    def topic(self, name: str, rows: DataFrame, delay: str, column: str = "event_time") -> DataFrame:
        """The rows of a topic with a watermark that outlives restarts."""
        ticks = self.spark.readStream.schema("ms bigint").json(f"{self.path}/topics/{name}")
        ticks = ticks.where("ms IS NOT NULL").select(F.timestamp_millis("ms").alias(column), F.lit(True).alias(_CLOCK))
        seen = rows.observe(f"seen_{name}", F.max(F.unix_millis(column)).alias("ms"))
        both = seen.unionByName(ticks, allowMissingColumns=True).withWatermark(column, delay)
        # a filter that names the event time is not moved below the watermark
        return both.where(F.when(F.col(column).isNotNull(), F.col(_CLOCK)).isNull()).drop(_CLOCK)

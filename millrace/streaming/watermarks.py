"""Event-time delays of the streaming jobs, and how they are set.

Spark drops rows that arrive behind the watermark; there is no further allowance and no
output for late rows. A longer delay means later results and fewer dropped rows.

A job that unites topics sets a watermark on each of them, and the slowest one counts
(``spark.sql.streaming.multipleWatermarkPolicy`` is ``min``). A topic without rows therefore
holds back the results of the job, instead of losing its rows when they come; where a topic
can be idle for long, ``clock.TopicClock.tick`` moves it on. Spark does not keep the watermark
of each topic over a restart; ``clock.TopicClock`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ORDERED = "0 seconds"
PAYMENT = "3 seconds"
SEARCH = "2 seconds"
VISIT_MEMORY = "1 day"

# Visitor statistics read bounces next to page views. A bounce is known only after its
# 10-second timeout, so a delay of one second would drop nearly all of them as late:
# the delay is the timeout plus one window.
VISITOR = "20 seconds"


def with_event_time(df: DataFrame, delay: str, column: str = "event_time") -> DataFrame:
    """Set a watermark on a stream; a static frame is left as it is."""
    return df.withWatermark(column, delay) if df.isStreaming else df


def without_repeats(df: DataFrame, keys: list[str], delay: str, column: str = "event_time") -> DataFrame:
    """Drop rows sent again within the delay, for sources that may replay."""
    if df.isStreaming:
        return df.withWatermark(column, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)

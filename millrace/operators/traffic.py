"""Visitor statistics per 10-second window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import times
from millrace.operators.visits import is_entry

DIMENSIONS = ("vc", "ch", "ar", "is_new")
MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def visitor_facts(pages: DataFrame, uniques: DataFrame, jumps: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Unique visitors, page views, session starts and bounces as rows of one shape.

    Page views and session starts come out of the same scan of the pages. Columns named in
    ``keep`` stay, for what is to be looked up once for all rows.
    """
    base = ["event_time", "ts", *DIMENSIONS, *keep]
    during = F.coalesce(F.col("during_time"), F.lit(0)).cast("bigint")
    kinds = F.when(is_entry(), F.array(F.lit("pv"), F.lit("sv"))).otherwise(F.array(F.lit("pv")))
    rows = (
        pages.select(*base, during.alias("_during"), F.explode(kinds).alias("kind"))
        .unionByName(uniques.select(*base, F.lit(0).cast("bigint").alias("_during"), F.lit("uv").alias("kind")))
        .unionByName(jumps.select(*base, F.lit(0).cast("bigint").alias("_during"), F.lit("uj").alias("kind")))
    )

    def one_if(kind: str):
        return F.when(F.col("kind") == kind, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return rows.select(
        *base,
        one_if("uv").alias("uv_ct"),
        one_if("pv").alias("pv_ct"),
        one_if("sv").alias("sv_ct"),
        one_if("uj").alias("uj_ct"),
        F.when(F.col("kind") == "pv", F.col("_during")).otherwise(F.lit(0)).cast("bigint").alias("dur_sum"),
    )


def visitor_stats(facts: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Sums per window, version, channel, area and new-visitor flag."""
    return (
        facts.groupBy(F.window("event_time", size), *DIMENSIONS)
        .agg(*[F.sum(m).alias(m) for m in MEASURES], F.min("ts").alias("ts"))
        .select(*times.window_bounds(), *DIMENSIONS, *MEASURES, "ts")
    )

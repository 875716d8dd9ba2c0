"""Joins: in an interval of event time, and against dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Estimated size up to which one side is sent to every executor.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate from file or relation sizes; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, size: int | None = None) -> DataFrame:
    """Hint a broadcast when the size (Spark's estimate unless given) allows it.

    Otherwise the side is left to a shuffle join, where adaptive execution splits the
    partitions of hot keys.
    """
    return F.broadcast(df) if (estimated_bytes(df) if size is None else size) <= limit else df


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    before: str,
    after: str,
    slices: int = 60,
    edges: Sequence[int] | None = None,
) -> DataFrame:
    """Inner equi-join, right time in ``[left time - before, left time + after]``.

    ``before`` and ``after`` are intervals such as ``5 seconds``, both ends included.
    The column names of the two sides must differ. On streams both sides need a
    watermark; the interval bounds the state kept for them.

    Rows only meet rows near them in time, so a slice of time, ``slices`` intervals long,
    is part of the key: the rows of a hot key are spread over its slices, and only those of
    one slice are compared. A left row whose interval crosses the edge of a slice is
    copied, at the default one in sixty.

    An interval that is long beside the time that all rows span makes one slice of it all.
    ``edges``, such as those of ``quantile_edges``, are then the edges of the slices, in
    milliseconds, and a left row is copied to all slices that its interval touches.
    """
    early, late = (int(pd.Timedelta(i).total_seconds() * 1000) for i in (before, after))
    span = max(slices * (early + late), 1)
    at = F.unix_millis(left_time)

    def slice_of(ms: Column) -> Column:
        if edges is None:
            return F.floor(ms / span)
        return F.size(F.filter(F.lit(list(edges)), lambda e: e <= ms)).cast("bigint") if edges else F.lit(0).cast("bigint")

    left = left.select("*", F.explode(F.sequence(slice_of(at - early), slice_of(at + late))).alias("_left_slice"))
    right = right.withColumn("_right_slice", slice_of(F.unix_millis(right_time)))
    same = F.col("_left_slice") == F.col("_right_slice")
    for ours, theirs in keys:
        same = same & (F.col(ours) == F.col(theirs))
    low = F.col(left_time) - F.expr(f"INTERVAL {before}")
    high = F.col(left_time) + F.expr(f"INTERVAL {after}")
    joined = left.join(right, same & (F.col(right_time) >= low) & (F.col(right_time) <= high), "inner")
    return joined.drop("_left_slice", "_right_slice")


def quantile_edges(rows: DataFrame, time: str, number: int = 16) -> list[int]:
    """Edges between ``number`` slices of time with about as many rows each, in milliseconds.

    One aggregation over the times; ``number`` values come to the driver.
    """
    shares = [i / number for i in range(1, number)]
    found = rows.agg(F.percentile_approx(F.unix_millis(time), shares, 1_000)).first()[0]
    return sorted(set(found or []))


def first_per_key(dim: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in the given order; reduced before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return dim.withColumn("_nth", F.row_number().over(ranked)).where("_nth = 1").drop("_nth")


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    fields: dict[str, Column],
    limit: int = BROADCAST_LIMIT_BYTES,
    size: int | None = None,
    first_by: Sequence[Column | str] = (),
) -> DataFrame:
    """Left join with a dimension; a miss keeps the row.

    ``on`` pairs a fact column with a dimension column; keys of different types are compared
    as text, which is how dimensions are stored. The dimension holds one row per key, or
    ``first_by`` gives the order in which the first row of a key wins. ``fields`` maps the
    output name to an expression over the dimension. A name the facts already have is
    replaced on a hit and kept on a miss.
    """
    if first_by:
        dim = first_per_key(dim, [theirs for _, theirs in on], first_by)
    keys = [f"_key{i}" for i in range(len(on))]
    side = dim.select(
        *[F.col(theirs).alias(k) for k, (_, theirs) in zip(keys, on)],
        *[value.alias(f"_dim_{name}") for name, value in fields.items()],
    )
    same = F.lit(True)
    for k, (ours, _) in zip(keys, on):
        if facts.schema[ours].dataType == side.schema[k].dataType:
            same = same & (F.col(ours) == F.col(k))
        else:
            same = same & (F.col(ours).cast("string") == F.col(k).cast("string"))
    joined = facts.join(broadcast_if_small(side, limit, size), same, "left")
    hit = F.col(keys[0]).isNotNull()
    kept = [
        F.when(hit, F.col(f"_dim_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in facts.columns
    ]
    new = [F.col(f"_dim_{name}").alias(name) for name in fields if name not in facts.columns]
    return joined.select(*kept, *new)

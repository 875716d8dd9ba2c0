"""Mixing sources to target weights by systematic sampling, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import narrow_broadcast, settle

# Fixed values of the contract: words, the weights in turn, the most copies of a document.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3

# Expected copies are counted in parts of this size, so that sums over rows are exact.
PARTS = 1 << 32


def mix_sources(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 0,
) -> DataFrame:
    """A row ``doc_id, source, size, source_size, target, copies, taken`` for each document.

    ``size`` is the number of words of the whole text. The sources in order of their code
    points, null last, weigh ``weights`` in turn and share the size of the whole table. A
    ``target`` ends at ``most`` times the size of its source; what is beyond it goes to the
    others by their weight, until none is above.

    Every document of a source is expected ``target / source_size`` times. The documents of
    a source stand in order of size, then id, then a hash of their row; the expected copies
    are summed up along this order, one random number below 1 is added for the source, and
    a document is emitted once for each whole number that its part of the sum crosses:
    ``copies`` times, ``taken`` words. As neighbours are alike in size, the words taken of a
    source miss the target by no more than about two of its longest documents. The random
    number is a hash of ``seed`` and the source, so runs agree.

    The order is made by ranges of (source, size, id), not by source, so a source that
    holds most rows is spread over all tasks; a place within the source is the place within
    the range plus the number of its rows in earlier ranges, of which there are as many as
    partitions and sources.

    Null and empty texts have size 0 and are emitted like others, taking no words. Repeated
    rows are documents of their own. Null sources are one source, null ids stay null. A
    source without words has target 0. An empty table gives no rows. Other columns are not
    looked at.
    """
    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(text)).alias("row_hash"),
    )
    sized = settle(given)
    placed = settle(_placed(sized, "source", ["size", "doc_id", "row_hash"]))
    sources = settle(source_targets(placed, weights, most))
    # a source has one row here: few bytes, but for its name
    small = narrow_broadcast(sources.withColumnRenamed("source", "its_source"), sources.count())
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    return (
        placed.join(small, F.col("source").eqNullSafe(F.col("its_source")), "left")
        .withColumn("copies", _crossed("place", "parts", offset.cast("decimal(12,0)")))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def _crossed(place: str, parts: str, offset: Column) -> Column:
    """Whole numbers between the sum of the expected copies before a place (from 1) and after it."""
    position = F.col(place).cast("decimal(18,0)")
    each = F.col(parts).cast("decimal(18,0)")

    def whole(rows: Column) -> Column:
        return F.call_function("div", rows * each + offset, F.lit(PARTS).cast("decimal(12,0)"))

    return whole(position) - whole(position - F.lit(1).cast("decimal(1,0)"))


def _placed(df: DataFrame, key: str | None, order: list[str]) -> DataFrame:
    """The rows with ``place``, from 1, in this order within each value of ``key`` (null last).

    Ranges of the whole order are counted off in parallel; per range and key one row says
    how many came before.
    """
    keys = [F.col(key).asc_nulls_last()] if key else []
    in_order = [*keys, *(F.col(c).asc_nulls_last() for c in order)]
    # rows alike in all of this are dealt over several ranges by their place in the table
    salted = df.withColumn("salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*in_order, F.col("salt")).sortWithinPartitions(*in_order, F.col("salt"))
    numbered = settle(ranged.drop("salt").withColumn("at", F.monotonically_increasing_id()))
    # the upper bits of ``at`` are the partition, in the order of the ranges
    part = F.shiftright("at", 33)
    by = [F.col(key).alias("of")] if key else [F.lit(0).alias("of")]
    heads = numbered.groupBy(*by, part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = settle(heads.withColumn("earlier", F.coalesce(F.sum("rows").over(before), F.lit(0))))
    same = (part == F.col("part")) & (F.col(key).eqNullSafe(F.col("of")) if key else F.lit(True))
    joined = numbered.join(narrow_broadcast(heads, heads.count()), same)
    return joined.withColumn("place", F.col("at") - F.col("first") + F.col("earlier") + 1).drop("at", "part", "of", "first", "rows", "earlier")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target, parts`` of each source, from rows ``source, size``.

    ``parts`` are the expected copies of each of its documents in units of ``1 / PARTS``.
    In turns, all sources that the rest of the whole, divided by weight among those that
    are not full, would overfill become full, until a turn fills none. A turn is one
    aggregation of the table of sources; three numbers come to the driver.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(w) for w in weights])
    weighed = _placed(sizes, None, ["source"]).withColumn(
        "weight", F.get(listed, ((F.col("place") - 1) % len(weights)).cast("int")).cast("long")
    )
    weighed = settle(weighed.drop("place"))
    whole, weight = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # what is left for those that are not full, and their weight: each turn fills more sources
    left, open_weight, full = whole, weight, 0
    while open_weight:
        above = F.lit(float(left)) * F.col("weight") / F.lit(float(open_weight)) > F.col("source_size") * most
        now_full, taken, heavy = weighed.where(above).agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.col("source_size") * most), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
        ).first()
        if now_full == full:
            break
        full, left, open_weight = now_full, whole - taken, weight - heavy
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(open_weight)) if open_weight else F.lit(float("inf"))
    target = F.least(share, (F.col("source_size") * most).cast("double"))
    copies = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return weighed.select("source", "source_size", target.alias("target"), F.floor(copies * PARTS).cast("long").alias("parts"))

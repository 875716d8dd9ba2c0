"""Change records: filter, normalise, route by configuration, apply to dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace import schemas
from millrace.functions.once import once
from millrace.operators.joins import broadcast_if_small

MIN_FIELDS = 3


def parse_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to ``table, type, data`` with the payload as a map of text."""
    record = F.from_json(F.col(value).cast("string"), schemas.CHANGE_RECORD)
    kept = [c for c in raw.columns if c != value]
    return raw.select(*kept, once(record).alias("record")).where("record IS NOT NULL").select(*kept, "record.*")


def order_of_changes(changes: DataFrame) -> DataFrame:
    """Parsed changes with ``seq``, by which those of a key are ordered, whatever partition of
    the topic they came in: when the record was made, its transaction and the position in
    it, and for records without these the partition and offset."""
    known = [F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)).alias(c) for c in ("ts", "xid", "xoffset")]
    place = [
        (F.col(c) if c in changes.columns else F.lit(0)).cast("bigint").alias(c) for c in ("partition", "offset")
    ]
    kept = [c for c in changes.columns if c not in ("ts", "xid", "xoffset", "partition", "offset")]
    return changes.select(*kept, F.struct(*known, *place).alias("seq"))


def usable_changes(changes: DataFrame) -> DataFrame:
    """Records with a table and a payload of at least three fields."""
    # three fields cannot be written in fewer than four characters, so the length
    # test on the payload text is implied by the count of fields
    return changes.where(F.col("table").isNotNull() & (F.size("data") >= MIN_FIELDS))


def normalise_type(changes: DataFrame) -> DataFrame:
    """Rows of an initial bulk load count as inserts."""
    plain = F.when(F.col("type") == "bootstrap-insert", F.lit("insert")).otherwise(F.col("type"))
    return changes.withColumn("type", plain)


def project_payload(data: Column, wanted: Column) -> Column:
    """Fields of a payload named in a comma-separated list; all when the list is empty."""
    kept = F.map_filter(data, lambda name, _: F.array_contains(F.split(wanted, ","), name))
    return F.when(F.coalesce(F.length(wanted), F.lit(0)) == 0, data).otherwise(kept)


def route_changes(changes: DataFrame, routing: DataFrame) -> DataFrame:
    """Normalised, usable changes with ``sink_type, sink_table, sink_pk``; the payload is cut
    to the configured columns. Records without a route are dropped.

    The routing table has one row per source table and operation; see
    ``sources.routing`` for its check.
    """
    side = routing.select(
        F.col("source_table").alias("_source"),
        F.col("operate_type").alias("_operation"),
        F.lower("sink_type").alias("sink_type"),
        "sink_table",
        "sink_columns",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"),
    )
    rows = normalise_type(usable_changes(changes))
    same = (F.col("table") == F.col("_source")) & (F.col("type") == F.col("_operation"))
    return (
        rows.join(broadcast_if_small(side), same, "inner")
        .withColumn("data", project_payload(F.col("data"), F.col("sink_columns")))
        .drop("_source", "_operation", "sink_columns")
    )


def fact_messages(routed: DataFrame) -> DataFrame:
    """Rows bound for topics: ``topic`` from the configuration, payload as JSON."""
    facts = routed.where("sink_type = 'kafka'")
    return facts.select(F.upper("sink_table").alias("topic"), F.to_json("data").alias("value"))


def dimension_changes(routed: DataFrame) -> DataFrame:
    """Rows bound for dimension tables; those without payload are skipped."""
    return routed.where("sink_type = 'hbase' AND size(data) > 0").withColumn("sink_table", F.upper("sink_table"))


def dimension_schema(sink_columns: str, sink_pk: str | None = None) -> StructType:
    """Schema of a dimension table from its configuration: text columns, key not null."""
    key = sink_pk or "id"
    return StructType([StructField(c, StringType(), nullable=c != key) for c in sink_columns.split(",")])


def apply_changes(
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    order: str,
    deletes: bool = True,
    set_at: str | None = None,
) -> DataFrame:
    """Current rows of a dimension after all changes, in order of the column ``order``.

    Each column holds the value of the latest change that carries it, so a change with
    some of the columns leaves the others as they were. A delete removes what came
    before it; ``deletes=False`` applies it like any other change. One aggregation: each
    column is reduced before the shuffle, so a key with very many changes is no problem.

    ``set_at`` names a map from column to the order of the change that set it, for changes
    that stand for several (null for others); the result then has this map too.
    """
    is_delete = (F.col("type") == "delete") if deletes else F.lit(False)
    data = F.col("data")

    def latest(name: str) -> Column:
        carried = ~is_delete & F.map_contains_key(data, F.lit(name))
        at = F.coalesce(F.col(set_at)[name], F.col(order)) if set_at else F.col(order)
        return F.max(F.when(carried, F.struct(at.alias("at"), data[name].alias("value")))).alias(f"_{name}")

    others = [c for c in columns if c != key]
    merged = (
        changes.withColumn("_pk", data[key])
        .where("_pk IS NOT NULL")
        .groupBy("_pk")
        .agg(
            F.max(F.when(is_delete, F.col(order))).alias("_gone"),
            F.max(F.when(~is_delete, F.col(order))).alias("_seen"),
            *[latest(c) for c in others],
        )
        .where("_seen IS NOT NULL AND (_gone IS NULL OR _seen > _gone)")
    )

    def current(name: str) -> Column:
        if name == key:
            return F.col("_pk").alias(name)
        alive = F.col("_gone").isNull() | (F.col(f"_{name}.at") > F.col("_gone"))
        return F.when(alive, F.col(f"_{name}.value")).alias(name)

    if not set_at:
        return merged.select(*[current(c) for c in columns])
    alive = [x for c in others for x in (F.lit(c), F.when(F.col("_gone").isNull() | (F.col(f"_{c}.at") > F.col("_gone")), F.col(f"_{c}.at")))]
    times = F.map_filter(F.create_map(F.lit(key), F.col("_seen"), *alive), lambda _, at: at.isNotNull())
    return merged.select(*[current(c) for c in columns], times.alias(set_at))

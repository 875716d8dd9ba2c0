"""Wide order and wide payment facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace import schemas
from millrace.functions import times
from millrace.functions.once import once
from millrace.operators.joins import BROADCAST_LIMIT_BYTES, estimated_bytes, interval_join, lookup


def typed(raw: DataFrame, schema: str, time_column: str | None = "create_time", value: str = "value") -> DataFrame:
    """JSON text to typed columns, with the event time read from a text column.

    Fields are read as text and cast, so a number may also come as a string.
    """
    fields = StructType.fromDDL(schema)
    as_text = StructType([StructField(f.name, StringType()) for f in fields])
    rows = (
        raw.select(once(F.from_json(F.col(value).cast("string"), as_text)).alias("row"))
        .where("row IS NOT NULL")
        .selectExpr(*[f"try_cast(row.{f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])
    )
    if time_column is None:
        return rows
    return rows.withColumn("event_time", times.text_to_time(F.col(time_column)))


def _taken(side: DataFrame, names: Mapping[str, str], prefix: str) -> list[Column]:
    return [F.col(theirs).alias(f"{prefix}{ours}") for ours, theirs in names.items() if theirs in side.columns]


# wide column: column of the order, of the detail
_FROM_ORDER = {
    "order_id": "id",
    "province_id": "province_id",
    "order_status": "order_status",
    "user_id": "user_id",
    "total_amount": "total_amount",
    "activity_reduce_amount": "activity_reduce_amount",
    "coupon_reduce_amount": "coupon_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "expire_time": "expire_time",
    "create_time": "create_time",
    "operate_time": "operate_time",
}
_FROM_DETAIL = {
    "detail_id": "id",
    "sku_id": "sku_id",
    "order_price": "order_price",
    "sku_num": "sku_num",
    "sku_name": "sku_name",
    "split_activity_amount": "split_activity_amount",
    "split_coupon_amount": "split_coupon_amount",
    "split_total_amount": "split_total_amount",
}


def _conform(df: DataFrame, schema: str, extra: Sequence[str] = ()) -> DataFrame:
    """Columns of a schema in its order; those the frame lacks are null."""
    fields = StructType.fromDDL(schema)
    have = set(df.columns)
    return df.selectExpr(
        *[f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields],
        *extra,
    )


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    before: str = "5 seconds",
    after: str = "5 seconds",
    edges: Sequence[int] | None = None,
) -> DataFrame:
    """Each order line with its order, where both were created close together.

    ``event_time`` is the order's. ``create_date`` and ``create_hour`` come from it. ``edges``
    are those of ``joins.interval_join``.
    """
    left = orders.select(F.col("event_time"), *_taken(orders, _FROM_ORDER, ""))
    right = details.select(
        F.col("event_time").alias("_detail_time"),
        F.col("order_id").alias("_detail_order"),
        *_taken(details, _FROM_DETAIL, ""),
    )
    joined = interval_join(left, right, [("order_id", "_detail_order")], "event_time", "_detail_time", before, after, edges=edges)
    dated = joined.withColumns(
        {
            "create_date": F.date_format("event_time", times.DAY_TEXT),
            "create_hour": F.date_format("event_time", "HH"),
        }
    )
    return _conform(dated, schemas.ORDER_WIDE, ["event_time"])


def payment_wide(
    payments: DataFrame, orders: DataFrame, within: str = "1800 seconds", edges: Sequence[int] | None = None
) -> DataFrame:
    """Each wide order line with the payment made at most ``within`` after the order.

    Where both have a column, the payment's wins (user, order, total amount).
    ``event_time`` is the payment's callback time, ``payment_time`` its create time.
    """
    left = payments.select(
        F.col("id").alias("payment_id"),
        "order_id",
        F.col("user_id"),
        "total_amount",
        "subject",
        "payment_type",
        F.col("create_time").alias("payment_create_time"),
        "callback_time",
        "event_time",
    )
    own = {"order_id", "user_id", "total_amount"}
    right = orders.select(
        F.col("order_id").alias("_wide_order"),
        F.col("event_time").alias("_order_time"),
        *[
            F.col(c).alias("order_create_time" if c == "create_time" else c)
            for c in orders.columns
            if c not in own and c != "event_time"
        ],
    )
    joined = interval_join(left, right, [("order_id", "_wide_order")], "event_time", "_order_time", within, "0 seconds", edges=edges)
    return _conform(joined, schemas.PAYMENT_WIDE, ["event_time"])


def fill_gaps(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides by key, each column from ``first`` unless null there.

    Both hold at most one row per key. It gives what a full outer join with coalesce
    gives, as a union with one aggregation: that reduces before the shuffle, and needs
    no handling of hot keys, which a full outer join cannot split.
    """
    values = [c for c in dict.fromkeys([*first.columns, *second.columns]) if c not in keys]
    both = first.withColumn("_side", F.lit(1)).unionByName(second.withColumn("_side", F.lit(2)), allowMissingColumns=True)

    def pick(name: str) -> Column:
        ours = F.max(F.when(F.col("_side") == 1, F.col(name)))
        theirs = F.max(F.when(F.col("_side") == 2, F.col(name)))
        return F.coalesce(ours, theirs).alias(name)

    return both.groupBy(*keys).agg(*[pick(c) for c in values])


def add_user(wide: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    age = times.age_in_years(F.to_date("BIRTHDAY"), as_of)
    return lookup(wide, users, [("user_id", "ID")], {"user_age": age, "user_gender": F.col("GENDER")})


def add_province(wide: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(
        wide,
        provinces,
        [("province_id", "ID")],
        {
            "province_name": F.col("NAME"),
            "province_3166_2_code": F.col("ISO_3166_2"),
            "province_iso_code": F.col("ISO_CODE"),
            "province_area_code": F.col("AREA_CODE"),
        },
    )


def product_dimension(dims: Mapping[str, DataFrame]) -> DataFrame:
    """The sku dimension with the names of its spu, category and trademark.

    Put together on the dimension side, so that facts of any size meet it in one join
    instead of four.
    """
    skus = dims["sku"].select(
        F.col("ID").alias("sku_id"),
        "SKU_NAME",
        F.col("CATEGORY3_ID").cast("bigint").alias("category3_id"),
        F.col("SPU_ID").cast("bigint").alias("spu_id"),
        F.col("TM_ID").cast("bigint").alias("tm_id"),
    )
    skus = lookup(skus, dims["spu"], [("spu_id", "ID")], {"spu_name": F.col("SPU_NAME")})
    skus = lookup(skus, dims["category3"], [("category3_id", "ID")], {"category3_name": F.col("NAME")})
    return lookup(skus, dims["trademark"], [("tm_id", "ID")], {"tm_name": F.col("TM_NAME")})


def add_product(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Product columns; the name of the dimension replaces that of the row on a hit."""
    fields = ["category3_id", "spu_id", "tm_id", "spu_name", "category3_name", "tm_name"]
    columns = {"sku_name": F.col("SKU_NAME"), **{f: F.col(f) for f in fields}}
    kept = rows.drop(*fields)
    # the estimate of a join is far too high, so the size is checked on its inputs;
    # joined rows are wider than those of the sku table, hence the smaller limit
    size = sum(estimated_bytes(dims[d]) for d in ("sku", "spu", "category3", "trademark"))
    return lookup(kept, product_dimension(dims), [("sku_id", "sku_id")], columns, BROADCAST_LIMIT_BYTES // 8, size)


def add_dimensions(wide: DataFrame, dims: Mapping[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """All six dimensions; ``as_of`` is when the age is taken, now by default."""
    as_of = F.current_timestamp() if as_of is None else as_of
    wide = add_user(wide, dims["user"], as_of)
    wide = add_province(wide, dims["province"])
    return add_product(wide, dims)

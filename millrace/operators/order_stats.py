"""Product and province statistics per 10-second window.

Distinct orders are counted in two steps: first one row per order within its group, then
the count. Both steps reduce before their shuffle, a group of any size is never held as a
set, and the two chained aggregations also run on a stream.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators.joins import lookup
from millrace.operators.wide import add_product

MONEY = "decimal(38,2)"


def _fact(
    rows: DataFrame,
    kind: str,
    order_id: Column | None = None,
    sku_num: Column | None = None,
    amount: Column | None = None,
    good: Column | None = None,
) -> DataFrame:
    def column(value: Column | None, default, data_type: str, name: str) -> Column:
        return (F.lit(default) if value is None else value).cast(data_type).alias(name)

    return rows.select(
        "event_time",
        F.col("sku_id").try_cast("bigint").alias("sku_id"),
        F.lit(kind).alias("kind"),
        column(order_id, None, "bigint", "order_id"),
        column(sku_num, 0, "bigint", "sku_num"),
        column(amount, 0, "decimal(18,2)", "amount"),
        column(good, 0, "bigint", "good"),
    )


def product_facts(
    pages: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    carts: DataFrame,
    favors: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
) -> DataFrame:
    """Eight kinds of rows of one shape, each about one product.

    ``payments`` holds wide payments with ``event_time`` at payment creation.
    """
    is_click, explode = F.col("page_id") == "good_detail", F.explode
    if pages.isStreaming:
        # what names the event time, or keeps rows without displays, is not moved below the
        # watermark, so that every page advances it
        is_click, explode = F.when(is_click, F.col("event_time")).isNotNull(), F.explode_outer
    clicks = pages.where(is_click).select("event_time", F.col("item").alias("sku_id"))
    displays = (
        pages.select("event_time", explode("display").alias("shown"))
        .where("shown.item_type = 'sku_id'")
        .select("event_time", F.col("shown.item").alias("sku_id"))
    )
    good = F.when(F.col("appraise") == schemas.APPRAISE_GOOD, 1).otherwise(0)
    parts = [
        _fact(clicks, "click"),
        _fact(displays, "display"),
        _fact(orders, "order", F.col("order_id"), F.col("sku_num"), F.col("split_total_amount")),
        _fact(carts, "cart"),
        _fact(payments, "payment", F.col("order_id"), amount=F.col("split_total_amount")),
        _fact(refunds, "refund", F.col("order_id"), amount=F.col("refund_amount")),
        _fact(favors, "favor"),
        _fact(comments, "comment", good=good),
    ]
    return reduce(DataFrame.unionByName, parts)


def _rewindow(df: DataFrame, size: str) -> Column:
    """The window column of a first aggregation, as the key of a second one."""
    if df.isStreaming:
        return F.window(F.window_time("window"), size)
    return F.col("window")


def product_counts(facts: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Counts, amounts and distinct orders per window and product."""
    per_order = facts.groupBy(F.window("event_time", size), "sku_id", "kind", "order_id").agg(
        F.count(F.lit(1)).alias("ct"),
        F.sum("sku_num").alias("sku_num"),
        F.sum("amount").alias("amount"),
        F.sum("good").alias("good"),
    )

    def total(kind: str, value: str, name: str, zero: str = "bigint") -> Column:
        mine = F.when(F.col("kind") == kind, F.col(value))
        return F.coalesce(F.sum(mine), F.lit(0)).cast(zero).alias(name)

    def orders(kind: str, name: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, F.col("order_id"))).alias(name)

    return (
        per_order.groupBy(_rewindow(per_order, size), "sku_id")
        .agg(
            total("display", "ct", "display_ct"),
            total("click", "ct", "click_ct"),
            total("favor", "ct", "favor_ct"),
            total("cart", "ct", "cart_ct"),
            total("order", "sku_num", "order_sku_num"),
            total("order", "amount", "order_amount", MONEY),
            orders("order", "order_ct"),
            total("payment", "amount", "payment_amount", MONEY),
            orders("payment", "paid_order_ct"),
            orders("refund", "refund_order_ct"),
            total("refund", "amount", "refund_amount", MONEY),
            total("comment", "ct", "comment_ct"),
            total("comment", "good", "good_comment_ct"),
        )
        .select(*times.window_bounds(), "*")
        .drop("window")
    )


PRODUCT_COLUMNS = (
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct",
)


def product_stats(facts: DataFrame, dims: Mapping[str, DataFrame], size: str = "10 seconds") -> DataFrame:
    return name_products(product_counts(facts, size), dims)


def name_products(counts: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Product counts with product dimensions, joined after the aggregation."""
    named = add_product(counts, dims)
    return named.withColumn("sku_price", F.lit(None).cast("decimal(18,2)")).select(*PRODUCT_COLUMNS)


def province_counts(orders: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Amount and distinct orders per window and province, from wide orders."""
    per_order = orders.groupBy(F.window("event_time", size), "province_id", "order_id").agg(
        F.sum("split_total_amount").alias("amount")
    )
    return (
        per_order.groupBy(_rewindow(per_order, size), "province_id")
        .agg(F.sum("amount").cast(MONEY).alias("order_amount"), F.count("order_id").alias("order_count"))
        .select(*times.window_bounds(), "province_id", "order_amount", "order_count")
    )


# Registers of a sketch of distinct orders, as a power of two: a standard error of about 1.6 %.
SKETCH_BITS = 12


def order_sketches(orders: DataFrame, size: str = "10 seconds", bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the distinct orders per window and province, of a size that does not grow.

    Unlike counts, sketches of windows can be put together to longer ones later.
    """
    sketch = F.hll_sketch_agg("order_id", bits).alias("orders")
    return orders.groupBy(F.window("event_time", size), "province_id").agg(sketch)


def approx_orders(sketches: DataFrame, size: str) -> DataFrame:
    """Distinct orders per longer window and province, from the sketches of shorter ones: an estimate."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("approx_order_count")
    return (
        sketches.groupBy(F.window("window.start", size).alias("longer"), "province_id")
        .agg(merged)
        .select(*times.window_bounds("longer"), "province_id", "approx_order_count")
    )


PROVINCE_COLUMNS = (
    "stt", "edt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2",
    "order_amount", "order_count",
)


def province_stats(orders: DataFrame, provinces: DataFrame, size: str = "10 seconds") -> DataFrame:
    return name_provinces(province_counts(orders, size), provinces)


def name_provinces(counts: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province counts with the province dimension, joined after the aggregation."""
    named = lookup(
        counts,
        provinces,
        [("province_id", "ID")],
        {
            "province_name": F.col("NAME"),
            "area_code": F.col("AREA_CODE"),
            "iso_code": F.col("ISO_CODE"),
            "iso_3166_2": F.col("ISO_3166_2"),
        },
    )
    return named.select(*PROVINCE_COLUMNS)


_PROVINCE_SQL = """
WITH per_order AS (
  SELECT window(event_time, '10 seconds') AS win, province_id, province_name,
         province_area_code, province_iso_code, province_3166_2_code, order_id,
         sum(split_total_amount) AS amount
  FROM {order_wide}
  GROUP BY window(event_time, '10 seconds'), province_id, province_name,
           province_area_code, province_iso_code, province_3166_2_code, order_id
), per_province AS (
  SELECT REGROUP AS win, province_id, province_name, province_area_code,
         province_iso_code, province_3166_2_code,
         count(order_id) AS order_count, CAST(sum(amount) AS DECIMAL(38, 2)) AS order_amount
  FROM per_order
  GROUP BY REGROUP, province_id, province_name, province_area_code,
           province_iso_code, province_3166_2_code
)
SELECT date_format(win.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(win.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       province_id, province_name, province_area_code AS area_code,
       province_iso_code AS iso_code, province_3166_2_code AS iso_3166_2,
       order_amount, order_count
FROM per_province
"""


def province_stats_sql(orders: DataFrame) -> DataFrame:
    """The same statistics as SQL, over wide orders that carry the province already."""
    again = "window(window_time(win), '10 seconds')" if orders.isStreaming else "win"
    return orders.sparkSession.sql(_PROVINCE_SQL.replace("REGROUP", again), order_wide=orders)

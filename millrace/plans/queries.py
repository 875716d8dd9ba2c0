"""Queries over the sample tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators import changes, keywords, logs, order_stats, traffic, visits, wide
from millrace.operators.joins import lookup
from millrace.sources.routing import load_routing
from millrace.sources.shop_tables import ShopTables
from millrace.sources.topics import json_view
from millrace.streaming import watermarks
from millrace.streaming.run import to_messages

# Sample order lines ship within 30 days of the order at best, not within seconds.
SPAN = "30 days"
AS_OF = "2024-02-01"
TIE = ("event_id",)
HAN_DIGITS = "零一二三四五六七八九"
HAN_WORDS = (HAN_DIGITS, "一二三", "零零", "二三")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[ShopTables], DataFrame]) -> Callable[[ShopTables], DataFrame]:
    _QUERIES[build.__name__] = lambda spark, folder: build(ShopTables(spark, folder))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# building blocks


def wide_orders(t: ShopTables) -> DataFrame:
    return wide.order_wide(t.orders, t.details, SPAN, SPAN, t.order_edges)


def wide_orders_with_province(t: ShopTables) -> DataFrame:
    return t.with_province(wide_orders(t))


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def visitor_fact_rows(t: ShopTables) -> DataFrame:
    """The area is looked up once, for all kinds of rows."""
    pages = t.pages_anywhere
    uniques, jumps = visits.unique_visits(pages, TIE), visits.user_jumps(pages, ties=TIE)
    return t.with_area(traffic.visitor_facts(pages, uniques, jumps, keep=("mid",)))


def product_fact_rows(t: ShopTables) -> DataFrame:
    # read twice: as what was ordered and as what was paid
    orders = t.layer("order_wide", lambda: wide_orders(t))
    payments = wide.payment_wide(t.payments, orders, SPAN, t.order_edges)
    return order_stats.product_facts(t.pages_anywhere, orders, payments, t.carts, t.favors, t.refunds, t.comments)


LOG_COLUMNS = ("mid", "vc", "ch", "ar", "is_new", "page_id", "last_page_id", "item", "during_time", "ts")
FACT_COLUMNS = ("ts", *traffic.DIMENSIONS, *traffic.MEASURES)


# logs


@_query
def log_parse(t: ShopTables) -> DataFrame:
    return logs.parse_logs(t.raw_logs).select(*LOG_COLUMNS)


@_query
def new_visitor_repair(t: ShopTables) -> DataFrame:
    return logs.repair_new_visitors(t.pages_anywhere).select("event_id", "mid", "is_new", "ts")


@_query
def split_start(t: ShopTables) -> DataFrame:
    return logs.start_logs(logs.parse_logs(t.raw_logs)).select("mid", F.col("start")["entry"].alias("entry"), "ts")


@_query
def split_page(t: ShopTables) -> DataFrame:
    return logs.page_logs(logs.parse_logs(t.raw_logs)).select(*LOG_COLUMNS)


@_query
def split_display(t: ShopTables) -> DataFrame:
    return logs.display_rows(logs.parse_logs(t.raw_logs))


@_query
def repaired_log_text(t: ShopTables) -> DataFrame:
    """The text written for the next layer, read back."""
    text = logs.log_text(logs.repair_new_visitors(logs.parse_logs(t.raw_logs)))
    return logs.parse_logs(text, encoded=False).select("mid", "is_new", "ts")


# visits


@_query
def session_entries(t: ShopTables) -> DataFrame:
    return visits.session_entries(t.pages_anywhere).select("event_id", "mid", "page_id", "ts")


@_query
def unique_visits(t: ShopTables) -> DataFrame:
    return visits.unique_visits(t.pages_anywhere, TIE).select("event_id", "mid", "page_id", "ts")


@_query
def user_jumps(t: ShopTables) -> DataFrame:
    return visits.user_jumps(t.pages_anywhere, ties=TIE).select("event_id", "mid", "page_id", "ts")


@_query
def user_jumps_30m(t: ShopTables) -> DataFrame:
    return visits.user_jumps(t.pages_anywhere, 30 * 60 * 1000, TIE).select("event_id", "mid", "page_id", "ts")


# change records


def _flat(rows: DataFrame, *keep: str) -> DataFrame:
    fields = [F.col("data")[name].alias(f"data_{name}") for name in ("event_id", "user_id", "value", "ts")]
    return rows.select("seq", *keep, *fields)


@_query
def cdc_filter(t: ShopTables) -> DataFrame:
    return _flat(changes.usable_changes(t.changes), "table", "type")


@_query
def cdc_normalise(t: ShopTables) -> DataFrame:
    return changes.normalise_type(t.changes).select("seq", "table", "type")


def _routed(t: ShopTables) -> DataFrame:
    return changes.route_changes(t.changes, load_routing(t.routing))


@_query
def cdc_route(t: ShopTables) -> DataFrame:
    return _routed(t).select("seq", "table", "type", "sink_type", "sink_table", "sink_pk")


@_query
def cdc_project_columns(t: ShopTables) -> DataFrame:
    return _flat(_routed(t), "sink_table")


@_query
def route_fact_topics(t: ShopTables) -> DataFrame:
    sent = changes.fact_messages(_routed(t))
    fields = F.from_json("value", "event_id string, user_id string, value string, ts string").alias("data")
    return sent.select("topic", fields).select("topic", "data.*")


@_query
def dim_upsert_latest(t: ShopTables) -> DataFrame:
    """Both dimension tables, one below the other."""
    rows = changes.dimension_changes(_routed(t))
    signups = changes.apply_changes(rows.where("sink_table = 'DIM_SIGNUP'"), "user_id", ["user_id", "value", "ts"], "seq")
    buyers = changes.apply_changes(rows.where("sink_table = 'DIM_PURCHASE'"), "event_id", ["event_id", "user_id"], "seq")
    return signups.unionByName(buyers, allowMissingColumns=True)


@_query
def dim_upsert_ordered(t: ShopTables) -> DataFrame:
    """The same changes as text of a topic with three partitions, whose offsets run against time."""
    record = F.to_json(F.struct("table", "type", "data", F.col("seq").alias("ts"), F.lit(7).alias("xid")))
    topic = t.changes.select(
        record.alias("value"), F.pmod("seq", F.lit(3)).cast("int").alias("partition"), (F.lit(10**9) - F.col("seq")).alias("offset")
    )
    parsed = changes.order_of_changes(changes.parse_changes(topic))
    routed = changes.dimension_changes(changes.route_changes(parsed, load_routing(t.routing)))
    signups = changes.apply_changes(routed.where("sink_table = 'DIM_SIGNUP'"), "user_id", ["user_id", "value", "ts"], "seq")
    buyers = changes.apply_changes(routed.where("sink_table = 'DIM_PURCHASE'"), "event_id", ["event_id", "user_id"], "seq")
    return signups.unionByName(buyers, allowMissingColumns=True)


# wide facts


@_query
def order_wide_interval(t: ShopTables) -> DataFrame:
    return wide_orders_with_province(t).select(
        "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
        "user_id", "total_amount", "split_total_amount", "create_time", "create_date", "create_hour",
    )


@_query
def payment_wide_interval(t: ShopTables) -> DataFrame:
    orders = wide_orders_with_province(t)
    return wide.payment_wide(t.payments, orders, SPAN, t.order_edges).select(
        "payment_id", "subject", "payment_type", "payment_create_time", "callback_time", "detail_id", "order_id",
        "sku_id", "user_id", "total_amount", "split_total_amount", "order_create_time", "province_id", "order_status",
    )


@_query
def order_wide_dims(t: ShopTables) -> DataFrame:
    return wide.add_dimensions(wide_orders_with_province(t), t.dims, as_of()).select(
        "detail_id", "order_id", "sku_id", "sku_name", "split_total_amount", "user_age", "user_gender",
        "province_name", "province_area_code", "province_iso_code", "province_3166_2_code", "spu_id", "tm_id",
        "category3_id", "spu_name", "tm_name", "category3_name",
    )


@_query
def wide_coalesce(t: ShopTables) -> DataFrame:
    """Order totals with their gaps filled from the order lines."""
    ours = t.orders.select(
        F.col("id").alias("order_id"),
        F.when(F.col("order_status") != "P", F.col("order_status")).alias("order_status"),
        "user_id",
        F.when(F.col("total_amount") >= 100000, F.col("total_amount")).cast("decimal(38,2)").alias("total_amount"),
    )
    lines = t.details.groupBy("order_id").agg(
        F.max("sku_name").alias("order_status"),
        F.sum("split_total_amount").cast("decimal(38,2)").alias("total_amount"),
        F.sum("sku_num").alias("sku_num"),
    )
    return wide.fill_gaps(ours, lines, ["order_id"])


@_query
def user_age(t: ShopTables) -> DataFrame:
    users = t.dims["user"]
    return users.select("ID", "BIRTHDAY", times.age_in_years(F.to_date("BIRTHDAY"), as_of()).alias("age"))


# typed topics and dimension reads


@_query
def typed_orders(t: ShopTables) -> DataFrame:
    """Orders written as JSON text and parsed back."""
    rows = wide.typed(to_messages(t.orders.drop("event_time")), schemas.ORDER_INFO)
    return rows.select("id", "user_id", "order_status", "total_amount", "create_time", F.unix_millis("event_time").alias("ts"))


@_query
def typed_details(t: ShopTables) -> DataFrame:
    rows = wide.typed(to_messages(t.details.drop("event_time")), schemas.ORDER_DETAIL)
    return rows.select("id", "order_id", "sku_id", "sku_num", "order_price", "sku_name", F.unix_millis("event_time").alias("ts"))


@_query
def typed_payments(t: ShopTables) -> DataFrame:
    rows = wide.typed(to_messages(t.payments.drop("event_time")), schemas.PAYMENT_INFO, "callback_time")
    return rows.select("id", "order_id", "user_id", "total_amount", "subject", "payment_type", F.unix_millis("event_time").alias("ts"))


@_query
def typed_wide_orders(t: ShopTables) -> DataFrame:
    """Wide orders as the order job writes them, read as the payment job does."""
    sent = to_messages(wide_orders_with_province(t).select(*schemas.column_names(schemas.ORDER_WIDE)))
    rows = wide.typed(sent, schemas.ORDER_WIDE)
    return rows.select(
        "detail_id", "order_id", "sku_id", "split_total_amount", "sku_name", "province_id", "create_date", "user_age",
        F.unix_millis("event_time").alias("ts"),
    )


@_query
def json_topic_view(t: ShopTables) -> DataFrame:
    """A topic of JSON text as a view, grouped in SQL by the day of its row time."""
    schema = "id bigint, total_amount decimal(18,2), create_time string"
    json_view(to_messages(t.orders.drop("event_time")), "orders_topic", schema, "to_timestamp(create_time)")
    return t.spark.sql(
        "SELECT date_format(rowtime, 'yyyy-MM-dd') AS day, count(id) AS orders, "
        "CAST(sum(total_amount) AS DECIMAL(38,2)) AS amount FROM orders_topic GROUP BY 1"
    )


@_query
def text_times(t: ShopTables) -> DataFrame:
    text = F.col("create_time")
    return t.orders.select(
        "id",
        F.unix_millis(times.text_to_time(text)).alias("time_ms"),
        times.text_to_millis(text).alias("ms"),
        times.text_to_day_millis(text).alias("day_ms"),
        times.millis_to_compact_day(times.text_to_millis(text)).alias("day"),
    )


@_query
def first_row_wins(t: ShopTables) -> DataFrame:
    """Nations with their first customer, from a dimension with many rows per key."""
    customers = t.spark.read.parquet(f"{t.folder}/customer.parquet")
    nations = t.dims["province"].select("ID", "NAME")
    return lookup(nations, customers, [("ID", "c_nationkey")], {"first_customer": F.col("c_name")}, first_by=["c_custkey"])


@_query
def replayed_events(t: ShopTables) -> DataFrame:
    """All page logs sent twice; one of each is kept."""
    rows = t.pages_anywhere.select("event_id", "mid", "ts", "event_time")
    return watermarks.without_repeats(rows.unionByName(rows), ["event_id"], "1 day").drop("event_time")


# statistics


@_query
def visitor_fact_union(t: ShopTables) -> DataFrame:
    return visitor_fact_rows(t).select(*FACT_COLUMNS)


@_query
def visitor_stats(t: ShopTables) -> DataFrame:
    return traffic.visitor_stats(visitor_fact_rows(t))


@_query
def product_facts(t: ShopTables) -> DataFrame:
    return product_fact_rows(t).select(
        F.unix_millis("event_time").alias("ts"), "sku_id", "kind", "order_id", "sku_num", "amount", "good"
    )


@_query
def product_stats(t: ShopTables) -> DataFrame:
    return order_stats.product_stats(product_fact_rows(t), t.dims)


@_query
def province_stats(t: ShopTables) -> DataFrame:
    return order_stats.province_stats(wide_orders_with_province(t), t.dims["province"])


@_query
def province_stats_sql(t: ShopTables) -> DataFrame:
    return order_stats.province_stats_sql(wide.add_province(wide_orders_with_province(t), t.dims["province"]))


@_query
def approx_province_orders(t: ShopTables) -> DataFrame:
    """Orders per province and day, about, from sketches of ten seconds."""
    return order_stats.approx_orders(order_stats.order_sketches(wide_orders_with_province(t)), "1 day")


@_query
def sink_projection(t: ShopTables) -> DataFrame:
    """Province statistics as rows of the store: named columns in its order, typed."""
    from millrace.sinks.tables import PROVINCE_TABLE, conform

    rows = order_stats.province_stats(wide_orders_with_province(t), t.dims["province"])
    return conform(rows, PROVINCE_TABLE).drop("ts")


# keywords


@_query
def search_terms(t: ShopTables) -> DataFrame:
    return keywords.search_terms(t.pages_anywhere).select("fullword", F.unix_millis("event_time").alias("ts"))


@_query
def search_keywords(t: ShopTables) -> DataFrame:
    found = keywords.split_keywords(keywords.search_terms(t.pages_anywhere), "fullword")
    return found.select("keyword", F.unix_millis("event_time").alias("ts"))


@_query
def keyword_stats_search(t: ShopTables) -> DataFrame:
    return keywords.keyword_stats(keywords.split_keywords(keywords.search_terms(t.pages_anywhere), "fullword"))


@_query
def counts_to_rows(t: ShopTables) -> DataFrame:
    counts = order_stats.product_counts(product_fact_rows(t)).select("sku_id", "click_ct", "cart_ct", "order_ct", "stt")
    return keywords.counts_to_rows(counts)


@_query
def product_keywords(t: ShopTables) -> DataFrame:
    return keywords.product_keywords(order_stats.product_stats(product_fact_rows(t), t.dims))


def _numbered_parts(t: ShopTables) -> DataFrame:
    """Names of parts, each with its number in Chinese digits and a word of ten characters."""
    number = F.translate(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), "0123456789", HAN_DIGITS)
    text = F.concat("p_name", number, F.lit(HAN_DIGITS)).alias("text")
    return t.spark.read.parquet(f"{t.folder}/part.parquet").select("p_partkey", text)


@_query
def chinese_pairs(t: ShopTables) -> DataFrame:
    return keywords.text_keywords(_numbered_parts(t))


@_query
def chinese_dictionary(t: ShopTables) -> DataFrame:
    words = t.spark.createDataFrame([(w,) for w in HAN_WORDS], "word string")
    found = keywords.dictionary_keywords(_numbered_parts(t), "text", words)
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("ct"))


@_query
def chinese_lattice(t: ShopTables) -> DataFrame:
    words = t.spark.createDataFrame([(w,) for w in HAN_WORDS], "word string")
    found = keywords.dictionary_keywords(_numbered_parts(t), "text", words, lattice=True)
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("ct"))


@_query
def document_keywords(t: ShopTables) -> DataFrame:
    return keywords.text_keywords(t.documents, by=["lang"])

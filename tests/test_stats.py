from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators import order_stats, traffic
from millrace.sinks import tables

T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
STT, EDT = "2024-01-01 00:00:00", "2024-01-01 00:00:10"


def at(df, column="ts"):
    return df.withColumn("event_time", times.millis_to_time(F.col(column)))


def page_rows(spark, rows):
    ddl = (
        "mid string, vc string, ch string, ar string, is_new string, page_id string, last_page_id string, "
        "item string, during_time bigint, display array<struct<item: string, item_type: string>>, ts bigint"
    )
    return at(spark.createDataFrame(rows, ddl))


def page(ts, page_id="home", last=None, item=None, during=5, display=None, ar="110000"):
    return ("m1", "v1", "web", ar, "1", page_id, last, item, during, display, ts)


def empty(spark, ddl):
    return spark.createDataFrame([], ddl + ", event_time timestamp")


def dims(spark):
    return {
        "sku": spark.createDataFrame([("1", "phone", "61", "7", "3")], "ID string, SKU_NAME string, CATEGORY3_ID string, SPU_ID string, TM_ID string"),
        "spu": spark.createDataFrame([("7", "phones")], "ID string, SPU_NAME string"),
        "category3": spark.createDataFrame([("61", "mobile")], "ID string, NAME string"),
        "trademark": spark.createDataFrame([("3", "acme")], "ID string, TM_NAME string"),
    }


def test_visitor_counts_per_window(spark):
    pages = page_rows(spark, [page(T0 + 1), page(T0 + 9_999, last="home", during=None), page(T0 + 10_000)])
    uniques = pages.where(F.col("ts") == T0 + 1)
    jumps = pages.where(F.col("ts") == T0 + 10_000)
    got = traffic.visitor_stats(traffic.visitor_facts(pages, uniques, jumps)).orderBy("stt").collect()
    assert [(r.stt, r.edt, r.uv_ct, r.pv_ct, r.sv_ct, r.uj_ct, r.dur_sum, r.ts) for r in got] == [
        (STT, EDT, 1, 2, 1, 0, 5, T0 + 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 0, 1, 1, 1, 5, T0 + 10_000),
    ]


def all_facts(spark, pages=(), orders=(), payments=(), carts=0, favors=0, refunds=(), comments=()):
    one = spark.createDataFrame([(1, T0)] * 3, "sku_id bigint, ts bigint")
    return order_stats.product_facts(
        page_rows(spark, list(pages)),
        at(spark.createDataFrame(list(orders), "sku_id bigint, order_id bigint, sku_num bigint, split_total_amount decimal(18,2), ts bigint")),
        at(spark.createDataFrame(list(payments), "sku_id bigint, order_id bigint, split_total_amount decimal(18,2), ts bigint")),
        at(one.limit(carts)),
        at(one.limit(favors)),
        at(spark.createDataFrame(list(refunds), "sku_id bigint, order_id bigint, refund_amount decimal(18,2), ts bigint")),
        at(spark.createDataFrame(list(comments), "sku_id bigint, appraise string, ts bigint")),
    )


def test_product_counts_of_all_kinds(spark):
    money = Decimal("10.00")
    shown = [("1", "sku_id"), ("9", "activity_id"), ("1", "sku_id")]
    facts = all_facts(
        spark,
        pages=[page(T0, "good_detail", item="1"), page(T0, "home", display=shown), page(T0, "home", item="1")],
        orders=[(1, 100, 2, money, T0), (1, 100, 1, money, T0), (1, 101, 1, money, T0)],
        payments=[(1, 100, money, T0), (1, 100, money, T0)],
        carts=2,
        favors=1,
        refunds=[(1, 100, money, T0), (1, 100, money, T0)],
        comments=[(1, schemas.APPRAISE_GOOD, T0), (1, "1203", T0)],
    )
    (row,) = order_stats.product_stats(facts, dims(spark)).collect()
    assert row.asDict() == {
        "stt": STT, "edt": EDT, "sku_id": 1, "sku_name": "phone", "sku_price": None, "spu_id": 7,
        "spu_name": "phones", "tm_id": 3, "tm_name": "acme", "category3_id": 61, "category3_name": "mobile",
        "display_ct": 2, "click_ct": 1, "favor_ct": 1, "cart_ct": 2, "order_sku_num": 4,
        "order_amount": Decimal("30.00"), "order_ct": 2, "payment_amount": Decimal("20.00"), "paid_order_ct": 1,
        "refund_order_ct": 1, "refund_amount": Decimal("20.00"), "comment_ct": 2, "good_comment_ct": 1,
    }


def test_a_window_with_a_single_row_counts_its_order(spark):
    facts = all_facts(spark, orders=[(1, 100, 2, Decimal("1.00"), T0)])
    (row,) = order_stats.product_counts(facts).collect()
    assert (row.order_ct, row.order_sku_num, row.refund_amount) == (1, 2, Decimal("0.00"))


def test_a_product_without_dimension_keeps_its_counts(spark):
    facts = all_facts(spark, orders=[(5, 100, 2, Decimal("1.00"), T0)])
    (row,) = order_stats.product_stats(facts, dims(spark)).collect()
    assert (row.sku_id, row.sku_name, row.spu_name, row.order_ct) == (5, None, None, 1)


def wide_rows(spark):
    money = Decimal("2.50")
    rows = [(5, 1, money, T0), (5, 1, money, T0 + 9_000), (5, 2, money, T0), (6, 3, money, T0), (5, 1, money, T0 + 10_000)]
    df = at(spark.createDataFrame(rows, "province_id bigint, order_id bigint, split_total_amount decimal(18,2), ts bigint"))
    return df.withColumns(
        {
            "province_name": F.lit("Beijing"),
            "province_area_code": F.lit("110000"),
            "province_iso_code": F.lit("CN-11"),
            "province_3166_2_code": F.lit("CN-BJ"),
        }
    )


EXPECTED = [
    (STT, 5, "Beijing", "110000", "CN-11", "CN-BJ", Decimal("7.50"), 2),
    (STT, 6, "Beijing", "110000", "CN-11", "CN-BJ", Decimal("2.50"), 1),
    ("2024-01-01 00:00:10", 5, "Beijing", "110000", "CN-11", "CN-BJ", Decimal("2.50"), 1),
]
PROVINCE = ["stt", "province_id", "province_name", "area_code", "iso_code", "iso_3166_2", "order_amount", "order_count"]


def test_province_stats_by_functions_and_by_sql(spark):
    dim = spark.createDataFrame(
        [(str(i), "Beijing", "CN-BJ", "CN-11", "110000") for i in (5, 6)],
        "ID string, NAME string, ISO_3166_2 string, ISO_CODE string, AREA_CODE string",
    )
    by_functions = order_stats.province_stats(wide_rows(spark), dim)
    by_sql = order_stats.province_stats_sql(wide_rows(spark))
    for got in (by_functions, by_sql):
        assert sorted(tuple(r) for r in got.select(*PROVINCE).collect()) == EXPECTED


@pytest.mark.parametrize("time_zone, stt", [("UTC", STT), ("Asia/Shanghai", "2024-01-01 08:00:00")])
def test_bounds_are_written_in_the_session_zone(spark, time_zone, stt):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    try:
        assert order_stats.province_counts(wide_rows(spark)).agg(F.min("stt")).first()[0] == stt
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_distinct_orders_reduce_before_both_shuffles(spark):
    plan = order_stats.province_counts(wide_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("HashAggregate(") == 4
    assert "collect_set" not in plan


def test_stored_rows_have_exactly_the_columns_of_the_table(spark):
    rows = order_stats.province_counts(wide_rows(spark)).withColumns(
        {c: F.lit("x") for c in ("province_name", "area_code", "iso_code", "iso_3166_2", "working_set")}
    )
    got = tables.conform(rows, tables.PROVINCE_TABLE)
    assert got.columns == schemas.column_names(tables.PROVINCE_TABLE)
    assert len(schemas.column_names(tables.PROVINCE_TABLE)) == 10
    assert len(schemas.column_names(tables.VISITOR_TABLE)) == 12
    assert got.where("ts IS NULL").count() == 0


def test_a_folder_batch_written_again_replaces_itself(spark, tmp_path):
    write = tables.folder_writer(str(tmp_path), "j")
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path)).count() == 7


def test_sketches_of_windows_merge_to_an_estimate_of_distinct_orders(spark):
    rows = spark.range(120_000).selectExpr("timestamp_seconds(id % 86400) AS event_time", "id % 40000 AS order_id", "1 AS province_id")
    sketches = order_stats.order_sketches(rows)
    assert sketches.count() == 8_640
    (day,) = order_stats.approx_orders(sketches, "1 day").collect()
    assert abs(day["approx_order_count"] / 40_000 - 1) < 0.05
    few = order_stats.approx_orders(order_stats.order_sketches(rows.where("order_id < 100")), "1 hour")
    exact = rows.where("order_id < 100").groupBy(F.window("event_time", "1 hour")).agg(F.count_distinct("order_id").alias("n"))
    assert sorted(r["approx_order_count"] for r in few.collect()) == sorted(r["n"] for r in exact.collect())

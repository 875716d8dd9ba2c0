"""Streams over folders: one file per batch, in order of modification time."""

import json
import os
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators import joins, logs, visits, wide
from millrace.plans.jobs import JOBS
from millrace.plans import stream_queries
from millrace.plans.queries import all_queries
from millrace.plans.launch import start_change_routing, start_job
from millrace.sinks.dimensions import DimensionTables
from millrace.sinks.tables import TABLES, folder_writer
from millrace.sinks.topics import topic_folders_writer
from millrace.operators.changes import dimension_schema
from millrace.sources.topics import file_text, json_view
from millrace.streaming import watermarks
from millrace.streaming.admission import Admission, start_admission
from millrace.streaming.clock import TopicClock
from millrace.streaming.first_seen import DailyVisits, FirstDays
from millrace.streaming.interval_batches import IntervalBatches
from millrace.streaming.run import run_to_folder, start, stream_session

DAY = 86_400_000


@pytest.fixture
def live(spark):
    return stream_session(spark, 2)


class Topic:
    """A folder that grows by one file of lines per batch."""

    def __init__(self, path):
        self.path = str(path)
        os.makedirs(self.path, exist_ok=True)
        self.files = 0

    def add(self, *records):
        name = f"{self.path}/{self.files:05d}.txt"
        with open(name, "w") as out:
            out.write("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in records))
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self

    def stream(self, spark):
        return file_text(spark, self.path, files_per_trigger=1)


def page(mid, ts, last=None, page_id="home", is_new="1", item=None, display=None):
    common = {"mid": mid, "vc": "v1", "ch": "web", "ar": "110000", "is_new": is_new}
    record = {"common": common, "page": {"page_id": page_id, "during_time": 5}, "ts": ts}
    if last:
        record["page"]["last_page_id"] = last
    if item:
        record["page"]["item"] = item
    if display:
        record["display"] = display
    return record


def flush(ts):
    return page("flush", ts, last="home")


def pages(topic, spark, delay):
    return logs.parse_logs(topic.stream(spark), encoded=False).withWatermark("event_time", delay)


def rows(spark, df, tmp_path, name="out"):
    schema = df.schema
    return spark.read.schema(schema).parquet(run_to_folder(df, name, str(tmp_path)))


def test_bounces_over_several_batches_equal_the_batch_form(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    # unordered within a batch; successors in the same batch, in a later one, or missing
    topic.add(page("a", 10_000), page("b", 15_000, "home"), page("b", 12_000))
    topic.add(page("c", 16_000), page("d", 17_000))
    topic.add(page("c", 25_999, "home"), page("d", 27_000, "home"), page("b", 30_000, "detail"))
    topic.add(page("e", 30_001), page("e", 30_000, "x"), page("f", 31_000), page("f", 36_000))
    topic.add(flush(10 * DAY))
    got = rows(spark, visits.user_jumps(pages(topic, live, "0 seconds")), tmp_path)
    static = logs.parse_logs(spark.read.text(topic.path), encoded=False)
    expected = {(r.mid, r.ts) for r in visits.user_jumps(static).collect()}
    assert {(r.mid, r.ts) for r in got.collect()} == expected
    assert expected == {("a", 10_000), ("d", 17_000), ("e", 30_001), ("f", 36_000)}


def test_bounces_do_not_depend_on_slices(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    topic.add(*[page("a", t) for t in (0, 9_000, 19_500, 20_500, 40_000, 49_999, 59_999)])
    topic.add(flush(DAY))
    short = visits.user_jumps(pages(topic, live, "0 seconds"), slice_ms=10_000)
    assert sorted(r.ts for r in rows(spark, short, tmp_path).collect()) == [9_000, 20_500, 49_999, 59_999]


def test_random_bounces_equal_the_batch_form(spark, live, tmp_path):
    dice = random.Random(7)
    topic = Topic(tmp_path / "pages")
    clock = 0
    for _ in range(4):
        times_of_batch = dice.sample(range(clock + 1, clock + 200_000), 120)
        clock += 200_000
        topic.add(
            *[
                page(f"m{dice.randrange(12)}", t, dice.choice([None, None, "home"]), is_new=dice.choice("01"))
                for t in times_of_batch
            ]
        )
    topic.add(flush(10 * DAY))
    static = logs.parse_logs(spark.read.text(topic.path), encoded=False)
    for timeout in (1_000, 10_000):
        bounces = visits.user_jumps(pages(topic, live, "0 seconds"), timeout)
        got = rows(spark, bounces, tmp_path, f"jumps{timeout}")
        expected = sorted((r.mid, r.ts) for r in visits.user_jumps(static, timeout).collect())
        assert len(expected) > 20
        assert sorted((r.mid, r.ts) for r in got.collect()) == expected


def test_unique_visits_once_per_device_and_date(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    topic.add(page("a", 1_000), page("a", 2_000, "home"), page("b", 3_000, "home"))
    topic.add(page("a", 5_000), page("b", 6_000))
    topic.add(page("a", DAY), page("a", DAY + 1))
    topic.add(page("a", 7_000))  # an earlier date again, still remembered
    got = rows(spark, visits.unique_visits(pages(topic, live, watermarks.VISIT_MEMORY)), tmp_path)
    assert sorted((r.mid, r.ts) for r in got.collect()) == [("a", 1_000), ("a", DAY), ("b", 6_000)]


def by_batch(spark, df, tmp_path, step, name="out"):
    """The rows of a stream, each batch taken through a step."""
    out = str(tmp_path / f"{name}-rows")

    def write(batch, batch_id):
        step(batch, batch_id).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    start(df, name, write, str(tmp_path / "state")).awaitTermination()
    return spark.read.parquet(out).collect()


def test_first_days_outlive_batches(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    topic.add(page("a", 1_000), page("b", 1_000, is_new="0"))
    topic.add(page("a", DAY), page("b", DAY), page("a", 2_000, display=[{"item": "1", "item_type": "sku_id"}]))
    topic.add(page("a", 9 * DAY), page("b", 2 * DAY), page("b", DAY + 5), page(None, 5))
    days = FirstDays(spark, str(tmp_path / "days"))
    got = by_batch(spark, logs.parse_logs(topic.stream(live), encoded=False), tmp_path, days.repair)
    assert {(r.mid, r.ts): r.is_new for r in got} == {
        ("a", 1_000): "1", ("b", 1_000): "0", ("a", DAY): "0", ("b", DAY): "1", ("a", 2_000): "1",
        ("a", 9 * DAY): "0", ("b", 2 * DAY): "0", ("b", DAY + 5): "1", (None, 5): "1",
    }
    shown = [r.display for r in got if r.ts == 2_000]
    assert [(d.item, d.item_type) for d in shown[0]] == [("1", "sku_id")]


def test_first_days_and_visits_over_many_batches_and_again(spark, live, tmp_path):
    """More batches than a bucket has folders, one of them run twice."""
    dice = random.Random(3)
    days, seen = FirstDays(spark, str(tmp_path / "days")), DailyVisits(spark, str(tmp_path / "seen"))
    days.table.buckets = seen.table.buckets = 2
    known, visited, oldest = {}, set(), 0
    for batch_id in range(11):
        events = [(f"m{dice.randrange(9)}", dice.randrange(batch_id * DAY // 3, (batch_id + 3) * DAY // 3)) for _ in range(25)]
        events += [("hot", batch_id * DAY // 3 + i) for i in range(50)]
        frame = spark.createDataFrame([(m, "1", None, t, i) for i, (m, t) in enumerate(events)], "mid string, is_new string, last_page_id string, ts long, nr long")
        for m, t in sorted(events, key=lambda e: e[1]):
            known.setdefault(m, t // DAY)
        expected = {(m, t, "1" if t // DAY == known[m] else "0") for m, t in events}
        firsts = {}
        for m, t in sorted(events, key=lambda e: e[1]):
            if (m, t // DAY) not in visited and t // DAY >= oldest:
                firsts.setdefault((m, t // DAY), t)
        for _ in range(2 if batch_id in (4, 9) else 1):
            assert {(r.mid, r.ts, r.is_new) for r in days.repair(frame, batch_id).collect()} == expected
            got = sorted((r.mid, r.ts) for r in seen.first(frame, batch_id, ["nr"]).collect())
            assert got == sorted((m, t) for (m, _), t in firsts.items())
        visited |= set(firsts)
        oldest = max(oldest, max(t for _, t in events) // DAY - 1)
    assert all(len(f) < 9 for f in days.table.manifest()["buckets"].values())
    assert len(days.table.versions()) <= 3


def test_rows_of_one_device_are_spread(spark, tmp_path):
    """A device with nearly all rows: its rows are in many tasks until they are written."""
    hot = spark.range(0, 200_000, 1, 8).selectExpr("'a' AS mid", "'1' AS is_new", "CAST(NULL AS string) AS last_page_id", "id AS ts")
    repaired = FirstDays(spark, str(tmp_path / "days")).repair(hot)
    per_task = repaired.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_task) <= 200_000 / 8
    plan = repaired._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def order(i, time, **more):
    return {"id": i, "province_id": 1, "user_id": 9, "order_status": "1001", "total_amount": "50.00", "create_time": time, **more}


def detail(i, order_id, time, sku=1):
    return {"id": i, "order_id": order_id, "sku_id": sku, "sku_num": 2, "sku_name": "own", "split_total_amount": 25.5, "create_time": time}


def test_wide_orders_join_across_batches_and_drop_late_rows(spark, live, tmp_path):
    orders = Topic(tmp_path / "orders").add(order(1, "2024-01-01 00:00:10")).add(order(2, "2024-01-01 00:01:00"))
    orders.add(order(3, "2024-01-01 01:00:00"))
    details = Topic(tmp_path / "details").add(detail(11, 1, "2024-01-01 00:00:15"), detail(12, 1, "2024-01-01 00:00:16"))
    details.add(detail(21, 2, "2024-01-01 00:00:55"))
    details.add(detail(31, 3, "2024-01-01 01:00:00"), detail(13, 1, "2024-01-01 00:00:10"))

    def typed(topic, schema):
        return wide.typed(topic.stream(live), schema).withWatermark("event_time", "0 seconds")

    got = wide.order_wide(typed(orders, schemas.ORDER_INFO), typed(details, schemas.ORDER_DETAIL))
    # line 13 arrives when the watermark is far past it
    assert sorted(r.detail_id for r in rows(spark, got, tmp_path).collect()) == [11, 21, 31]


def test_repeats_within_the_delay_are_dropped(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages").add(page("a", 1_000), page("a", 1_000)).add(page("a", 1_000), page("a", 2_000))
    parsed = logs.parse_logs(topic.stream(live), encoded=False)
    once = watermarks.without_repeats(parsed, ["mid", "ts"], "1 minute")
    assert sorted(r.ts for r in rows(spark, once, tmp_path).collect()) == [1_000, 2_000]


def test_a_json_topic_as_a_view(spark, live, tmp_path):
    topic = Topic(tmp_path / "t").add({"page": {"page_id": "good_list", "item": "x"}, "ts": 1_500})
    ddl = "common map<string,string>, page map<string,string>, ts bigint"
    json_view(topic.stream(live), "page_view", ddl, "timestamp_seconds(ts div 1000)", "2 seconds")
    sql = live.sql("SELECT page['item'] AS fullword, rowtime FROM page_view WHERE page['page_id'] = 'good_list'")
    (row,) = rows(spark, sql, tmp_path).collect()
    assert row.fullword == "x" and row.rowtime.timestamp() == 1


def test_bounces_of_repeats_and_unnamed_devices_equal_the_batch_form(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    topic.add(page("a", 1_000), page("a", 1_000), page(None, 2_000), page(None, 4_000, "home"), page(None, 50_000))
    topic.add(page("b", 60_000), page("b", 60_000, "home"), flush(DAY))
    topic.add(flush(10 * DAY))
    static = logs.parse_logs(spark.read.text(topic.path), encoded=False)
    expected = sorted((str(r.mid), r.ts) for r in visits.user_jumps(static, ties=["body"]).collect())
    got = rows(spark, visits.user_jumps(pages(topic, live, "0 seconds"), ties=["body"]), tmp_path)
    assert sorted((str(r.mid), r.ts) for r in got.collect()) == expected
    assert ("a", 1_000) in expected and ("None", 50_000) in expected and ("None", 2_000) not in expected


def test_a_slow_topic_loses_no_rows_to_a_fast_one(spark, live, tmp_path):
    fast, slow = Topic(tmp_path / "pages"), Topic(tmp_path / "paid")
    paid = {"sku_id": 1, "order_id": 1, "split_total_amount": 9, "payment_create_time": "1970-01-01 00:00:05"}
    fast.add(page("a", 1_000, page_id="good_detail", item="1")).add(flush(DAY)).add(flush(2 * DAY)).add(flush(3 * DAY))
    later = {**paid, "order_id": 2, "payment_create_time": "1970-01-02 00:00:00"}
    slow.add({**paid, "payment_create_time": "1970-01-01 00:00:01"}).add({}).add(paid).add(later)
    closing = Topic(tmp_path / "others").add({"sku_id": 1, "create_time": "1970-01-03 00:00:00"})
    closing = closing.stream(live)
    names = JOBS["product_stats"].reads
    topics = {n: closing for n in names} | {"DWD_PAGE_LOG": fast.stream(live), "DWM_PAYMENT_WIDE": slow.stream(live)}
    got = rows(spark, JOBS["product_stats"].core(topics), tmp_path).where("sku_id = 1").collect()
    day = [r for r in got if r.stt.startswith("1970-01-01")]
    assert [(r.click_ct, r.paid_order_ct, str(r.payment_amount)) for r in day] == [(1, 1, "18.00")]


# whole jobs


def dims(spark):
    return {
        "user": spark.createDataFrame([("9", "1990-01-01", "F")], "ID string, BIRTHDAY string, GENDER string"),
        "province": spark.createDataFrame(
            [("1", "Beijing", "CN-BJ", "CN-11", "110000")],
            "ID string, NAME string, ISO_3166_2 string, ISO_CODE string, AREA_CODE string",
        ),
        "sku": spark.createDataFrame(
            [("1", "phone", "61", "7", "3")],
            "ID string, SKU_NAME string, CATEGORY3_ID string, SPU_ID string, TM_ID string",
        ),
        "spu": spark.createDataFrame([("7", "Red Phone")], "ID string, SPU_NAME string"),
        "category3": spark.createDataFrame([("61", "mobile")], "ID string, NAME string"),
        "trademark": spark.createDataFrame([("3", "acme")], "ID string, TM_NAME string"),
    }


class Warehouse:
    """All topics and tables as folders."""

    def __init__(self, spark, live, path):
        self.spark, self.live, self.path = spark, live, str(path)

    def topic_path(self, name):
        return f"{self.path}/topics/{name}"

    def read(self, name):
        os.makedirs(self.topic_path(name), exist_ok=True)
        return self.live.readStream.schema("value string").option("recursiveFileLookup", "true").text(self.topic_path(name))

    def writer(self, job, name):
        if name in TABLES:
            return folder_writer(f"{self.path}/tables/{name}", job, name)
        return topic_folders_writer(f"{self.path}/topics", name)

    def run(self, job):
        query = start_job(job, self.read, self.writer, dims(self.spark).__getitem__, f"{self.path}/state")
        query.awaitTermination()

    def topic(self, name):
        lines = self.spark.read.option("recursiveFileLookup", "true").text(self.topic_path(name)).collect()
        return [json.loads(r.value) for r in lines]

    def table(self, name):
        return self.spark.read.parquet(f"{self.path}/tables/{name}").collect()


def test_the_jobs_chained_from_logs_and_changes_to_statistics(spark, live, tmp_path):
    w = Warehouse(spark, live, tmp_path)
    base = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
    Topic(w.topic_path("ODS_BASE_LOG")).add(
        page("a", base + 1_000, page_id="home", display=[{"item": "1", "item_type": "sku_id"}]),
        page("b", base + 2_000, page_id="home"),
        page("b", base + 3_000, "home", "good_list", item="Red phone"),
        page("b", base + 4_000, "good_list", "good_detail", item="1"),
        {"common": {"mid": "a", "is_new": "1"}, "start": {"entry": "icon"}, "ts": base},
        "{broken",
        flush(base + DAY),
    )
    w.run("log_split")
    assert len(w.topic("DWD_START_LOG")) == 1
    assert len(w.topic("DWD_PAGE_LOG")) == 5
    assert [(d["page_id"], d["item"]) for d in w.topic("DWD_DISPLAY_LOG")] == [("home", "1")]

    w.run("unique_visit")
    w.run("user_jump")
    assert {d["common"]["mid"] for d in w.topic("DWM_UNIQUE_VISIT")} == {"a", "b"}
    assert [d["common"]["mid"] for d in w.topic("DWM_USER_JUMP_DETAIL")] == ["a"]

    # every topic goes on: one without later rows would hold its windows back
    for topic in ("DWM_UNIQUE_VISIT", "DWM_USER_JUMP_DETAIL"):
        Topic(w.topic_path(topic)).add(flush(base + DAY))
    w.run("visitor_stats")
    (stats,) = w.table("visitor_stats")
    assert (stats.uv_ct, stats.pv_ct, stats.sv_ct, stats.uj_ct, stats.dur_sum) == (2, 4, 2, 1, 20)

    Topic(w.topic_path("DWD_ORDER_INFO")).add(order(1, "2024-01-01 00:00:03"), order(2, "2024-01-02 00:00:00"))
    Topic(w.topic_path("DWD_ORDER_DETAIL")).add(
        detail(11, 1, "2024-01-01 00:00:04"), detail(12, 1, "2024-01-01 00:00:05"), detail(21, 2, "2024-01-02 00:00:00")
    )
    w.run("order_wide")
    wide_rows = w.topic("DWM_ORDER_WIDE")
    assert {(d["detail_id"], d["spu_name"], d["user_gender"], d["province_name"]) for d in wide_rows} == {
        (i, "Red Phone", "F", "Beijing") for i in (11, 12, 21)
    }

    pay = {"id": 5, "order_id": 1, "user_id": 9, "total_amount": 51, "subject": "s", "payment_type": "1101"}
    Topic(w.topic_path("DWD_PAYMENT_INFO")).add(
        {**pay, "create_time": "2024-01-01 00:00:06", "callback_time": "2024-01-01 00:10:00"}
    )
    w.run("payment_wide")
    assert {d["detail_id"] for d in w.topic("DWM_PAYMENT_WIDE")} == {11, 12}

    Topic(w.topic_path("DWD_CART_INFO")).add({"sku_id": 1, "create_time": "2024-01-01 00:00:07"})
    Topic(w.topic_path("DWD_FAVOR_INFO")).add({"sku_id": "1", "create_time": "2024-01-01 00:00:07"})
    refund = {"sku_id": 1, "order_id": 1, "refund_amount": 2.5, "create_time": "2024-01-01 00:00:08"}
    Topic(w.topic_path("DWD_ORDER_REFUND_INFO")).add(refund)
    comment = {"sku_id": 1, "appraise": "1201", "create_time": "2024-01-01 00:00:09"}
    Topic(w.topic_path("DWD_COMMENT_INFO")).add(comment)
    Topic(w.topic_path("DWM_PAYMENT_WIDE")).add({"payment_create_time": "2024-01-02 00:00:00"})
    for topic in ("DWD_CART_INFO", "DWD_FAVOR_INFO", "DWD_ORDER_REFUND_INFO", "DWD_COMMENT_INFO"):
        Topic(f"{w.topic_path(topic)}/later").add({"create_time": "2024-01-02 00:00:00"})
    w.run("product_stats")
    (product,) = w.table("product_stats")
    counted = {k: v for k, v in product.asDict().items() if k.endswith("_ct")}
    assert counted == {
        "display_ct": 1, "click_ct": 1, "favor_ct": 1, "cart_ct": 1, "order_ct": 1, "paid_order_ct": 1,
        "refund_order_ct": 1, "comment_ct": 1, "good_comment_ct": 1,
    }
    assert (product.spu_name, str(product.order_amount), str(product.payment_amount)) == ("Red Phone", "51.00", "51.00")

    for job in ("province_stats", "province_stats_sql"):
        w.run(job)
        (province,) = [r for r in w.table("province_stats") if r.job == job]
        assert (province.province_name, province.order_count, str(province.order_amount)) == ("Beijing", 1, "51.00")

    w.run("keyword_search")
    assert {(r.keyword, r.ct, r.source) for r in w.table("keyword_stats")} == {("red", 1, "SEARCH"), ("phone", 1, "SEARCH")}
    w.run("keyword_product")
    from_products = {(r.keyword, r.ct, r.source) for r in w.table("keyword_stats") if r.job == "keyword_product"}
    assert from_products == {(k, 1, s) for k in ("red", "phone") for s in ("CLICK", "CART", "ORDER")}


def test_every_job_also_runs_on_static_frames(spark):
    one = spark.createDataFrame([("{}",)], "value string")
    for job in JOBS.values():
        for frame in job.run({topic: one for topic in job.reads}, dims(spark)).values():
            assert frame.columns


def test_changes_are_routed_with_routes_read_per_batch(spark, live, tmp_path):
    routes = [
        ("user", "insert", "hbase", "dim_user", "id,name", None, None),
        ("brand", "insert", "HBase", "dim_brand", "tm_id,tm_name", "tm_id", None),
    ]
    extra = [
        ("user", "delete", "hbase", "dim_user", "id,name", None, None),
        ("orders", "insert", "kafka", "dwd_order", "id", None, None),
    ]
    calls = []

    def read_routing():
        calls.append(1)
        return spark.createDataFrame(routes + (extra if len(calls) > 1 else []), schemas.ROUTING)

    def change(offset, table, kind, i, name):
        record = {"table": table, "type": kind, "data": {"id": i, "name": name, "x": 0}}
        return {"offset": offset, "value": json.dumps(record)}

    topic = Topic(tmp_path / "changes")
    topic.add(
        change(0, "user", "bootstrap-insert", 1, "a"),
        change(1, "user", "insert", 2, "b"),
        change(2, "orders", "insert", 7, "n"),
    )
    topic.add(change(3, "user", "delete", 1, "a"), change(4, "orders", "insert", 8, "n"))
    raw = topic.stream(live).select(
        F.get_json_object("value", "$.value").alias("value"),
        F.get_json_object("value", "$.offset").cast("bigint").alias("offset"),
    )
    tables = DimensionTables(spark, str(tmp_path / "dims"))
    facts = topic_folders_writer(str(tmp_path / "facts"))
    start_change_routing(raw, read_routing, facts, tables, str(tmp_path / "state")).awaitTermination()

    users = tables.read("DIM_USER", dimension_schema("id,name")).collect()
    assert [tuple(r) for r in users] == [("2", "b")]
    # a table without changes exists, without rows
    assert tables.latest("DIM_BRAND").columns == ["tm_id", "tm_name"]
    assert tables.latest("DIM_BRAND").count() == 0
    sent = spark.read.text(str(tmp_path / "facts" / "by_topic"))
    assert [(r.topic, json.loads(r.value)) for r in sent.collect()] == [("DWD_ORDER", {"id": "8"})]


def test_an_empty_routing_table_fails_the_batch(spark, live, tmp_path):
    topic = Topic(tmp_path / "changes").add({"table": "t", "type": "insert", "data": {"a": 1, "b": 2, "c": 3}})
    raw = topic.stream(live).withColumn("offset", F.lit(0))
    tables = DimensionTables(spark, str(tmp_path / "dims"))
    empty = lambda: spark.createDataFrame([], schemas.ROUTING)
    query = start_change_routing(raw, empty, topic_folders_writer(str(tmp_path)), tables, str(tmp_path / "state"))
    with pytest.raises(Exception, match="empty"):
        query.awaitTermination()


def test_a_restarted_query_goes_on_where_it_stopped(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages").add(page("a", 1_000))
    write = folder_writer(str(tmp_path / "table"), "copy")

    def run():
        start(pages(topic, live, "0 seconds").select("mid", "ts"), "copy", write, str(tmp_path / "state")).awaitTermination()

    run()
    topic.add(page("b", 2_000))
    run()
    run()
    assert sorted(r.mid for r in spark.read.parquet(str(tmp_path / "table")).collect()) == ["a", "b"]


@pytest.mark.parametrize("kept", [True, False])
def test_a_topic_without_rows_after_a_restart_still_counts(spark, live, tmp_path, kept):
    fast, slow = Topic(tmp_path / "fast"), Topic(tmp_path / "slow")
    clock = TopicClock(live, str(tmp_path / "clock"))

    def run():
        clock.start(["fast", "slow"] if kept else [])
        if not kept:
            for name in ("fast", "slow"):
                clock.files.write(f"topics/{name}/empty.json", b"")
        topics = {"fast": fast, "slow": slow}
        parsed = {n: logs.parse_logs(t.stream(live), encoded=False).select("mid", "event_time") for n, t in topics.items()}
        both = clock.topic("fast", parsed["fast"], "0 seconds").unionByName(clock.topic("slow", parsed["slow"], "0 seconds"))
        counts = both.groupBy(F.window("event_time", "10 seconds")).count().select(F.unix_millis("window.start").alias("at"), "count")
        run_to_folder(counts, "counts", str(tmp_path), clock=clock)
        return {r["at"]: r["count"] for r in spark.read.schema(counts.schema).parquet(str(tmp_path / "counts" / "rows")).collect()}

    fast.add(page("a", 1_000))
    slow.add(page("a", 2_000), page("b", 2 * DAY))
    assert run() == {}
    fast.add(page("a", DAY)).add(page("a", DAY + 1))  # the slow topic has nothing new when the job starts again
    # with the clock it counts as far as it had come, without it as far back as can be
    assert run() == ({0: 2} if kept else {})
    slow.add(page("b", DAY + 5_000))
    fast.add(page("a", 3 * DAY))
    assert run()[0] == 2
    if kept:
        assert clock.highest() == {"fast": 3 * DAY, "slow": 2 * DAY}
        for topic in ("slow", "fast"):
            clock.tick(topic, 9 * DAY)
        # idle topics are moved on, and all windows are complete
        assert run() == {0: 2, DAY: 3, 2 * DAY: 1, 3 * DAY: 1}


def test_rows_counted_late_and_repeated_add_up_to_rows_in(spark, live, tmp_path):
    topic = Topic(tmp_path / "pages")
    topic.add(page("a", 1_000), page("a", 1_000), page("b", DAY))
    topic.add(page("a", 1_000), page("c", DAY - 30_000), page("d", DAY - 90_000), {"common": {"mid": "x"}, "page": {"page_id": "p"}})
    topic.add(page("c", DAY - 30_000), page("e", 3 * DAY))
    admission = Admission(spark, str(tmp_path / "keys"), ["mid", "ts"], "1 minute")
    rows = logs.parse_logs(topic.stream(live), encoded=False).select("mid", "ts", "event_time")
    writer = lambda verdict: folder_writer(str(tmp_path / verdict), "pages")
    start_admission(rows, admission, writer, "admission", str(tmp_path / "state")).awaitTermination()
    got = {v: sorted((r.mid, r.ts) for r in spark.read.parquet(str(tmp_path / v)).collect()) for v in ("on_time", "late", "repeated")}
    assert got["on_time"] == [("a", 1_000), ("b", DAY), ("c", DAY - 30_000), ("e", 3 * DAY)]
    assert got["repeated"] == [("a", 1_000), ("c", DAY - 30_000)]
    assert sorted(got["late"], key=str) == [("a", 1_000), ("d", DAY - 90_000), ("x", None)]
    # a batch run again gets the same verdicts
    again = spark.createDataFrame([("e", 3 * DAY), ("c", DAY - 30_000)], "mid string, ts long").withColumn("event_time", times.millis_to_time(F.col("ts")))
    assert sorted((r.mid, r.admission) for r in admission.judge(again, 2).collect()) == [("c", "repeated"), ("e", "on_time")]


def test_larger_tables_have_more_state_partitions(spark, tmp_path, monkeypatch):
    for name in ("events", "orders", "lineitem"):
        fields = [f"CAST(id AS string) AS {f.split()[0]}" for f in stream_queries.TABLES[name].split(", ")]
        spark.range(1_000).selectExpr(*fields).write.parquet(f"{tmp_path}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    few = stream_queries.Streams(spark, str(tmp_path), "few").spark
    assert few.conf.get("spark.sql.shuffle.partitions") == str(cores)
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file())
    monkeypatch.setattr(stream_queries, "STATE_PARTITION_BYTES", size // (3 * cores))
    many = stream_queries.Streams(spark, str(tmp_path), "many").spark
    assert int(many.conf.get("spark.sql.shuffle.partitions")) >= 3 * cores


def test_state_is_written_without_being_read_to_count_it(spark, live, tmp_path):
    counted = pages(Topic(tmp_path / "pages").add(page("a", 1), page("b", 2)), live, "0 seconds").groupBy("mid").count()
    query = counted.writeStream.format("noop").outputMode("update").option("checkpointLocation", str(tmp_path / "checkpoint"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    state = [operator for progress in query.recentProgress for operator in progress["stateOperators"]]
    assert sum(operator["numRowsUpdated"] for operator in state) == 2
    assert max(operator["numRowsTotal"] for operator in state) <= 0


def order_row(key, ms, customer=1):
    return (key, customer, "O", 10.0, ms, "1-URGENT")


def shop(spark, folder, orders, lines, events=()):
    """Tables of own rows, in milliseconds, with three customers, provinces and products."""
    def table(name, rows, time=None):
        fields = [f.split() for f in stream_queries.TABLES[name].split(", ")]
        schema = ", ".join(f"{n} {'bigint' if n == time else t}" for n, t in fields)
        df = spark.createDataFrame(list(rows), schema)
        if time:
            df = df.withColumn(time, F.timestamp_millis(time).cast("timestamp_ntz"))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    table("orders", orders, "o_orderdate")
    table("lineitem", lines, "l_shipdate")
    table("events", events, "ts")
    table("customer", [(i, f"c{i}", i, 1.0, "s") for i in range(3)])
    table("nation", [(i, f"n{i}", 0) for i in range(3)])
    table("region", [(0, "r")])
    table("part", [(i, f"p{i}", f"Brand#{i}", "T", 1, 1.0) for i in range(3)])
    return str(folder)


def line_row(key, number, ms, part=1, flag="N"):
    return (key, part, 1, number, 2.0, 5.0, 0.0, 0.0, flag, "F", ms)


def bytes_below(folder, without):
    files = [f for f in folder.rglob("*") if f.is_file()]
    return sum(f.stat().st_size for f in files if not any(w in f"{f}" for w in without))


@pytest.fixture(scope="module")
def shop_folder(spark, tmp_path_factory):
    """Orders of four years, most with a line within 30 days and one long after."""
    r = random.Random(5)
    keys = range(8_000)
    at = {k: (9_000 + r.randrange(1_500)) * DAY for k in keys}
    orders = [order_row(k, at[k], k % 4) for k in keys]
    lines = [line_row(k, n, at[k] + r.randrange(-40, 120) * DAY, r.randrange(4), r.choice("RN")) for k in keys for n in (1, 2)]
    events = [
        (i, (9_000 + r.randrange(1_500)) * DAY, i % 50, r.choice(list(stream_queries.PAGE_OF_EVENT)), 1.0, json.dumps({"k": r.randrange(4)}))
        for i in range(1_000)
    ]
    return shop(spark, tmp_path_factory.mktemp("shop"), orders, lines, events)


def run_both(spark, folder, name):
    """A stream query and its batch form, as rows in order."""
    queries = [stream_queries.all_stream_queries()[name], all_queries()[name.removeprefix("stream_")]]
    return [sorted(map(str, q(spark, folder).collect())) for q in queries]


def test_orders_that_wait_for_lines_take_no_more_room_than_the_tables(spark, shop_folder, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "checkpoint_root", lambda _: str(tmp_path))
    got, expected = run_both(spark, shop_folder, "stream_province_stats")
    assert got == expected and len(got) > 1_000
    (folder,) = tmp_path.glob("stream_province_stats-*")
    # a state of one entry per row took about ten times as much
    assert bytes_below(folder / "order_wide", ("/rows/",)) < bytes_below(folder / "tables", ())


def test_products_counted_take_no_room_for_rows_that_wait(spark, shop_folder, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "checkpoint_root", lambda _: str(tmp_path))
    got, expected = run_both(spark, shop_folder, "stream_product_stats")
    assert got == expected and len(got) > 1_000
    (folder,) = tmp_path.glob("stream_product_stats-*")
    joins_take = sum(bytes_below(folder / name, ("/rows/",)) for name in ("order_wide", "payment_wide"))
    assert joins_take < 1.5 * bytes_below(folder / "tables", ())


def test_state_takes_less_room_than_as_spark_writes_it(spark, live, tmp_path):
    spark.range(40_000).selectExpr("id % 7 AS kind", "id", "timestamp_seconds(id) AS event_time").write.parquet(str(tmp_path / "in"))

    def room(session, name):
        rows = session.readStream.schema("kind bigint, id bigint, event_time timestamp").parquet(str(tmp_path / "in"))
        counts = rows.groupBy(F.window("event_time", "10 seconds"), "kind", "id").count()
        query = counts.writeStream.format("noop").outputMode("update").option("checkpointLocation", str(tmp_path / name))
        query.trigger(availableNow=True).start().awaitTermination()
        return bytes_below(tmp_path / name / "state", ())

    plain = stream_session(spark, 2)
    for session in (live, plain):  # else the checkpoint has the changes, not the state
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "false")
    plain.conf.unset("spark.sql.streaming.stateStore.rocksdb.compression")
    assert room(live, "ours") < 0.9 * room(plain, "plain")


def test_a_join_batch_by_batch_gives_the_rows_of_a_join_of_streams(spark, tmp_path):
    r = random.Random(3)
    side = lambda n, at: spark.createDataFrame(
        [(i, r.choice([1, 2, 3, None]), r.choice([None, *range(*at)]) if i % 9 == 0 else r.randrange(*at)) for i in range(n)],
        "id bigint, key int, s bigint",
    ).select("id", "key", F.timestamp_seconds("s").alias("event_time"))

    def operator(left, right):
        return joins.interval_join(
            left.select(F.col("id").alias("l"), F.col("key").alias("lk"), F.col("event_time").alias("lt")),
            right.select(F.col("id").alias("r"), F.col("key").alias("rk"), F.col("event_time").alias("rt")),
            [("lk", "rk")], "lt", "rt", "5 seconds", "3 seconds",
        )

    late = spark.range(100, 101).select("id", F.lit(1).alias("key"), F.timestamp_seconds(F.lit(20)).alias("event_time"))
    parts = [(side(30, (k * 40, k * 40 + 40)), side(40, (k * 40, k * 40 + 40))) for k in range(4)]
    expected = sorted(map(str, operator(*[_united(p[s] for p in parts) for s in (0, 1)]).collect()))
    waits = IntervalBatches(spark, str(tmp_path / "waits"), "5 seconds", "3 seconds", "0 seconds")
    got = []
    for k, (left, right) in enumerate(parts):
        batch = waits.both(_united([left, late]) if k == 2 else left, right)
        first = sorted(map(str, waits.join(batch, k, operator).collect()))
        if k != 2:  # before and after the rows of the batch are said to be written
            waits.done(k)
        assert sorted(map(str, waits.join(batch, k, operator).collect())) == first
        waits.done(k)
        got += first
    assert sorted(got) == expected and len(got) > 20
    # what waits is what the watermark leaves; of earlier batches only the last one's stay
    assert sorted(os.listdir(tmp_path / "waits" / "waiting")) == ["000000000002", "000000000003"]
    waiting = spark.read.parquet(str(tmp_path / "waits" / "waiting" / "000000000003"))
    assert 0 < waiting.count() < 40
    assert os.listdir(tmp_path / "waits" / "arrived") == []


def _united(frames):
    return reduce(DataFrame.unionByName, frames)


def test_rows_wait_until_both_topics_have_passed(spark, tmp_path):
    waits = IntervalBatches(spark, str(tmp_path / "waits"), "1 second", "1 second", "0 seconds")
    row = lambda *at: spark.createDataFrame([(s,) for s in at], "s bigint").select(F.timestamp_seconds("s").alias("event_time"))
    operator = lambda left, right: joins.interval_join(
        left.toDF("lt").withColumn("lk", F.lit(1)), right.toDF("rt").withColumn("rk", F.lit(1)), [("lk", "rk")], "lt", "rt", "1 second", "1 second"
    )
    found = lambda k, left, right: waits.join(waits.both(left, right), k, operator).count()
    assert found(0, row(10, 500), row()) == 0
    waits.done(0)
    assert found(1, row(), row(11)) == 1
    waits.done(1)
    assert found(2, row(11, 12), row(12, 499)) == 3  # 11 is at the watermark and late; 12 with 12 and 11, 500 with 499

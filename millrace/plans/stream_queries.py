"""The streaming forms over the sample tables, run to the end of the available input.

The tables arrive in parts, in order of time. A query is stopped after each part and goes on
from its checkpoint with the next one, so its state crosses batches and restarts. Closing
rows far in the future follow the last part: they move the watermarks past all real rows,
whose results are then complete, and are left out of the results.

Each layer is written to a folder in the checkpoint directory and read as a stream by
the next, as topics would be.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators import keywords, order_stats, traffic, visits, wide
from millrace.operators.joins import estimated_bytes
from millrace.plans.queries import SPAN, TIE
from millrace.session import checkpoint_root
from millrace.sources.shop_tables import PAGE_OF_EVENT, TABLES, ShopTables
from millrace.streaming import watermarks
from millrace.streaming.admission import Admission
from millrace.streaming.clock import TopicClock
from millrace.streaming.first_seen import DailyVisits, FirstDays
from millrace.streaming.interval_batches import IntervalBatches, Operator
from millrace.streaming.run import run_to_folder, start, stream_session

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


PARTS = 3
# The second time closes what the first one opened.
CLOSING_TIMES = ("2100-01-01 00:00:00", "2100-01-02 00:00:00")

# So much of the files of the tables goes to one state partition.
STATE_PARTITION_BYTES = 16 * 1024 * 1024

_TIME_COLUMN = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
# lines are cut at the times of their orders, as both are read side by side
_CUT_BY = {"events": "events", "orders": "orders", "lineitem": "orders"}
_CLOSING_ROWS = {
    "events": [
        {"event_id": "-1", "user_id": "-1", "event_type": kind, "value": "0", "props": '{"k": 2}'} for kind in PAGE_OF_EVENT
    ],
    "orders": [{"o_orderkey": "-1", "o_custkey": "-1", "o_orderstatus": "O", "o_totalprice": "0"}],
    "lineitem": [
        {"l_orderkey": "-1", "l_partkey": "-1", "l_suppkey": "-1", "l_linenumber": "1", "l_quantity": "0",
         "l_extendedprice": "0", "l_discount": "0", "l_tax": "0", "l_returnflag": "R"}
    ],
}


def _closing_rows(spark: SparkSession, name: str) -> DataFrame:
    fields = StructType.fromDDL(TABLES[name])
    rows = [
        tuple({**row, _TIME_COLUMN[name]: at}.get(f.name) for f in fields) for at in CLOSING_TIMES for row in _CLOSING_ROWS[name]
    ]
    texts = spark.createDataFrame(rows, ", ".join(f"{f.name} string" for f in fields))
    return texts.select(*[F.col(f.name).cast(f.dataType) for f in fields])


def _without_closing(rows: DataFrame) -> DataFrame:
    start = F.lit(CLOSING_TIMES[0])
    limits = {"stt": start, "create_time": start, "callback_time": start, "ts": F.unix_millis(start.cast("timestamp"))}
    column = next(c for c in limits if c in rows.columns)
    return rows.where(F.col(column) < limits[column])


class GrowingTables(ShopTables):
    """Streams over folders to which the sample tables are written part by part."""

    def __init__(self, spark: SparkSession, folder: str, grown: str):
        super().__init__(spark, folder, streaming=True)
        self.grown = grown
        self.written: dict[str, int] = {}

    def _facts(self, name: str) -> DataFrame:
        path = f"{self.grown}/{name}.parquet"
        if name not in self.written:
            self._static(name).limit(0).write.parquet(path)
            self.written[name] = 0
        return self.spark.readStream.schema(TABLES[name]).parquet(path)

    def _part(self, name: str) -> DataFrame:
        """The rows that come next; the last part has the closing rows."""
        k = self.written[name]
        seconds = F.unix_seconds(F.col(_TIME_COLUMN[_CUT_BY[name]]).cast("timestamp"))
        low, high = self._static(_CUT_BY[name]).agg(F.min(seconds), F.max(seconds)).first()
        mine = F.unix_seconds(F.col(_TIME_COLUMN[name]).cast("timestamp"))
        place = F.floor((mine - F.lit(low)) * PARTS / F.lit((high or 0) - (low or 0) + 1))
        place = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(PARTS - 1), place)), F.lit(0))
        rows = self._static(name).where(place == k)
        return rows.unionByName(_closing_rows(self.spark, name)) if k == PARTS - 1 else rows

    def grow(self) -> bool:
        """Write the next part of the tables in use; whether there was one."""
        due = [name for name, k in self.written.items() if k < PARTS]
        for name in due:
            self._part(name).write.mode("append").parquet(f"{self.grown}/{name}.parquet")
            self.written[name] += 1
        return bool(due)


def _state_partitions(spark: SparkSession, folder: str) -> int:
    """At least one per core, and so many that the state of each does not grow with the tables."""
    tables = ShopTables(spark, folder)
    size = sum(estimated_bytes(tables._static(name)) for name in _TIME_COLUMN)
    return max(spark.sparkContext.defaultParallelism, -(-size // STATE_PARTITION_BYTES))


@dataclass(frozen=True)
class Joined:
    """Two topics, and the operator that joins them batch by batch."""

    left: DataFrame
    right: DataFrame
    operator: Operator
    before: str
    after: str
    delay: str
    further: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def then(self, step: Callable[[DataFrame], DataFrame]) -> Joined:
        """With one more step over the rows of each batch."""
        return replace(self, further=lambda rows: step(self.further(rows)))

    @property
    def schema(self) -> StructType:
        spark = self.left.sparkSession
        return self.further(self.operator(*[spark.createDataFrame([], t.schema) for t in (self.left, self.right)])).schema


class Streams:
    """Streams over the sample tables, with folders between the layers."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.caller = spark
        self.spark = stream_session(spark, _state_partitions(spark, folder))
        self.spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
        self.root = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.layers = 0
        self.live = GrowingTables(self.spark, folder, f"{self.root}/tables")
        self.static = ShopTables(self.spark, folder)

    def run(self, df: DataFrame | Joined, name: str) -> str:
        """Run a stream over each part of its tables, from where it stopped.

        A stream that also reads a layer gets all parts at once: after a restart a topic
        counts as idle until it has new rows, and a layer has none.
        """
        go = self._joining(df, name) if isinstance(df, Joined) else lambda: run_to_folder(df, name, self.root)
        out = None
        while self.live.grow():
            if not self.layers:
                out = go()
        return out or go()

    def _joining(self, joined: Joined, name: str) -> Callable[[], str]:
        out = f"{self.root}/{name}/rows"
        waits = IntervalBatches(self.spark, f"{self.root}/{name}/waits", joined.before, joined.after, joined.delay)
        both = waits.both(joined.left, joined.right)

        def write(batch: DataFrame, batch_id: int) -> None:
            rows = joined.further(waits.join(batch, batch_id, joined.operator))
            rows.write.mode("overwrite").parquet(f"{out}/{batch_id:012d}")
            waits.done(batch_id)

        def go() -> str:
            start(both, name, write, self.root).awaitTermination()
            return f"{out}/*"

        return go

    def result(self, df: DataFrame | Joined, name: str) -> DataFrame:
        schema = df.schema
        return _without_closing(self.caller.read.schema(schema).parquet(self.run(df, name)))

    def batches(self, df: DataFrame, name: str, step: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
        """Run each batch of a stream through ``step``, part by part, and read the results."""
        out = f"{self.root}/{name}/rows"

        def write(batch: DataFrame, batch_id: int) -> None:
            step(batch, batch_id).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        while self.live.grow():
            start(df, name, write, self.root).awaitTermination()
        return _without_closing(self.caller.read.parquet(out).drop("batch"))

    def layer(self, df: DataFrame | Joined, name: str) -> DataFrame:
        """Run a stream into a folder and read that folder as a stream."""
        schema = df.schema
        folder = self.run(df, name)
        self.layers += 1
        return self.spark.readStream.schema(schema).parquet(folder)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write a static frame and read it as a stream."""
        path = f"{self.root}/{name}/table"
        df.write.parquet(path)
        return self.spark.readStream.schema(df.schema).parquet(path)

    def pages(self, delay: str) -> DataFrame:
        return watermarks.with_event_time(self.live.pages_anywhere, delay)

    def by_part(self, layers: dict[str, DataFrame], build: Callable[[dict[str, DataFrame]], DataFrame], name: str) -> DataFrame:
        """Run layers and what reads them over one part after another, each stopped in between.

        ``build`` goes from streams with watermarks, by topic, to the result; "live" is the
        page logs. A topic may have no rows in a part.
        """
        clock = TopicClock(self.spark, f"{self.root}/{name}/clock")
        schemas = {topic: df.schema for topic, df in layers.items()}
        out = schema = None
        while self.live.grow():
            folders = {topic: run_to_folder(df, topic, self.root) for topic, df in layers.items()}
            clock.start(["live", *layers])
            topics = {t: self.spark.readStream.schema(schemas[t]).parquet(folder) for t, folder in folders.items()}
            topics = {t: clock.topic(t, rows, watermarks.VISITOR) for t, rows in {"live": self.live.pages, **topics}.items()}
            df = build(topics)
            schema = df.schema
            out = run_to_folder(df, name, self.root, clock=clock)
        return _without_closing(self.caller.read.schema(schema).parquet(out))

    def order_wide(self) -> Joined:
        operator = lambda orders, details: wide.order_wide(orders, details, SPAN, SPAN)
        joined = Joined(self.live.orders, self.live.details, operator, SPAN, SPAN, watermarks.ORDERED)
        return joined.then(self.static.with_province)

    def payment_wide(self, orders: DataFrame) -> Joined:
        # of all lines, those that close included: the wide orders have been run by now
        payments = self.table(ShopTables(self.spark, self.live.grown).payments, "payment_info")
        operator = lambda paid, ordered: wide.payment_wide(paid, ordered, SPAN)
        return Joined(payments, orders, operator, SPAN, "0 seconds", watermarks.PAYMENT)

    def unique_visits(self, pages: DataFrame) -> DataFrame:
        return visits.unique_visits(watermarks.with_event_time(pages, watermarks.VISIT_MEMORY), TIE)

    def user_jumps(self, pages: DataFrame) -> DataFrame:
        return visits.user_jumps(watermarks.with_event_time(pages, watermarks.ORDERED), ties=TIE)


def _query(build: Callable[[Streams], DataFrame]) -> Callable[[Streams], DataFrame]:
    name = build.__name__
    _QUERIES[name] = lambda spark, folder: build(Streams(spark, folder, name))
    return build


def all_stream_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def stream_new_visitor_repair(s: Streams) -> DataFrame:
    days = FirstDays(s.spark, f"{s.root}/first_days")
    return s.batches(s.live.pages_anywhere.select("event_id", "mid", "is_new", "ts"), "repaired", days.repair)


@_query
def stream_daily_visits(s: Streams) -> DataFrame:
    seen = DailyVisits(s.spark, f"{s.root}/daily_visits")
    pages = visits.session_entries(s.live.pages_anywhere).select("event_id", "mid", "page_id", "last_page_id", "ts")
    return s.batches(pages, "daily", lambda rows, batch_id: seen.first(rows, batch_id, TIE)).drop("last_page_id")


@_query
def stream_admission(s: Streams) -> DataFrame:
    """Page logs of which some come when their part is long over and some twice, with a verdict each."""
    pages = s.static.pages_anywhere.select("event_id", "mid", "item", "ts", "event_time")
    low, high = pages.agg(F.min("ts"), F.max("ts")).first()
    part = F.floor((F.col("ts") - F.lit(low)) * PARTS / F.lit((high or 0) - (low or 0) + 1)).cast("int")
    digit = F.col("item").cast("int") % 10
    sent = F.when(digit == 3, F.array(F.lit(PARTS - 1))).when(digit == 7, F.array(part, F.least(part + 1, F.lit(PARTS - 1))))
    sent = pages.withColumn("sent_in", F.explode(F.coalesce(sent, F.array(part))))
    topic = f"{s.root}/admission/topic"
    admission = Admission(s.spark, f"{s.root}/admission/keys", ["event_id"], "11 days")
    out = f"{s.root}/admission/rows"
    for k in range(PARTS):
        sent.where(F.col("sent_in") == k).drop("sent_in").coalesce(1).write.mode("append").parquet(topic)
        rows = s.spark.readStream.schema(pages.schema).parquet(topic)

        def write(batch: DataFrame, batch_id: int) -> None:
            admission.judge(batch, batch_id).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        start(rows, "admission", write, s.root).awaitTermination()
    return s.caller.read.parquet(out).select("event_id", "admission")


@_query
def stream_unique_visits(s: Streams) -> DataFrame:
    # the first to arrive is kept: the same row as in the batch form, as events are in order
    return s.result(s.unique_visits(s.live.pages_anywhere).select("event_id", "mid", "page_id", "ts"), "uniques")


@_query
def stream_user_jumps(s: Streams) -> DataFrame:
    return s.result(s.user_jumps(s.live.pages_anywhere).select("event_id", "mid", "page_id", "ts"), "jumps")


@_query
def stream_order_wide(s: Streams) -> DataFrame:
    columns = ("detail_id", "order_id", "sku_id", "split_total_amount", "create_time")
    return s.result(s.order_wide().then(lambda rows: rows.select(*columns)), "wide")


@_query
def stream_payment_wide(s: Streams) -> DataFrame:
    paid = s.payment_wide(s.layer(s.order_wide(), "order_wide"))
    columns = ("payment_id", "detail_id", "user_id", "total_amount", "callback_time")
    return s.result(paid.then(lambda rows: rows.select(*columns)), "paid")


@_query
def stream_visitor_stats(s: Streams) -> DataFrame:
    uniques = s.layer(s.unique_visits(s.live.pages), "unique_visit")
    jumps = s.layer(s.user_jumps(s.live.pages), "user_jump")
    topics = [watermarks.with_event_time(rows, watermarks.VISITOR) for rows in (s.live.pages, uniques, jumps)]
    return s.result(traffic.visitor_stats(traffic.visitor_facts(*topics)), "visitor_stats")


@_query
def stream_visitor_stats_by_part(s: Streams) -> DataFrame:
    """The same, all jobs stopped after each part of the input and started again."""
    layers = {"uniques": s.unique_visits(s.live.pages), "jumps": s.user_jumps(s.live.pages)}
    facts = lambda t: traffic.visitor_facts(t["live"], t["uniques"], t["jumps"])
    return s.by_part(layers, lambda topics: traffic.visitor_stats(facts(topics)), "visitor_stats")


@_query
def stream_product_stats(s: Streams) -> DataFrame:
    orders = s.layer(s.order_wide(), "order_wide")
    paid = s.layer(s.payment_wide(orders), "payment_wide")
    t = s.live
    topics = (t.pages_anywhere, orders, paid, t.carts, t.favors, t.refunds, t.comments)
    facts = order_stats.product_facts(*[watermarks.with_event_time(rows, watermarks.ORDERED) for rows in topics])
    return s.result(order_stats.product_stats(facts, s.static.dims), "product_stats")


@_query
def stream_province_stats(s: Streams) -> DataFrame:
    orders = watermarks.with_event_time(s.layer(s.order_wide(), "order_wide"), watermarks.ORDERED)
    return s.result(order_stats.province_stats(orders, s.static.dims["province"]), "province_stats")


@_query
def stream_province_stats_sql(s: Streams) -> DataFrame:
    named = s.order_wide().then(lambda rows: wide.add_province(rows, s.static.dims["province"]))
    orders = watermarks.with_event_time(s.layer(named, "order_wide"), watermarks.ORDERED)
    return s.result(order_stats.province_stats_sql(orders), "province_stats")


@_query
def stream_keyword_stats(s: Streams) -> DataFrame:
    terms = keywords.search_terms(s.pages(watermarks.SEARCH))
    return s.result(keywords.keyword_stats(keywords.split_keywords(terms, "fullword")), "keyword_stats")

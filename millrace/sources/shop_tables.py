"""Shop streams derived from the sample tables.

``events`` become page logs, carts, favors, comments and change records; ``orders`` and
``lineitem`` become orders, order lines, payments and refunds; ``customer``, ``nation``,
``region`` and ``part`` become dimensions with text columns. With ``streaming`` the facts
are streams over the same files, the dimensions stay static.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.functions.once import once
from millrace.operators.joins import lookup, quantile_edges
from millrace.session import checkpoint_root

# Schemas of the sample tables. Given to the reader, they spare it a job per
# table that looks them up in the files.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Page shown for each type of event.
PAGE_OF_EVENT = {
    "view": "good_detail",
    "click": "good_list",
    "signup": "home",
    "purchase": "trade",
    "error": "mine",
}

# Routes of the change records, one source table per type of event.
ROUTES = [
    ("click", "insert", "kafka", "dwd_click", "event_id,user_id,value", None, None),
    ("click", "update", "Kafka", "dwd_click", "", None, None),
    ("view", "insert", "kafka", "dwd_view", None, None, None),
    ("signup", "insert", "hbase", "dim_signup", "user_id,value,ts", "user_id", None),
    ("signup", "update", "HBASE", "dim_signup", "user_id,value", "user_id", None),
    ("signup", "delete", "hbase", "dim_signup", "user_id,value,ts", "user_id", None),
    ("purchase", "insert", "hbase", "dim_purchase", "event_id,user_id", "event_id", None),
]


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


class ShopTables:
    def __init__(self, spark: SparkSession, folder: str, streaming: bool = False):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.streaming = streaming
        self._tables: dict[str, DataFrame] = {}

    def _static(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _facts(self, name: str) -> DataFrame:
        if not self.streaming:
            return self._static(name)
        reader = self.spark.readStream.schema(TABLES[name])
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Rows that several operators read, written once, as a topic between two jobs would be."""
        if name not in self._tables:
            rows = build()
            path = f"{checkpoint_root(self.spark)}/layers/{name}-{uuid.uuid4().hex}"
            rows.write.parquet(path)
            self._tables[name] = self.spark.read.schema(rows.schema).parquet(path)
        return self._tables[name]

    @cached_property
    def order_edges(self) -> list[int]:
        """Slices of time with as many orders each."""
        return quantile_edges(self.orders, "event_time")

    # events

    @cached_property
    def events(self) -> DataFrame:
        ms = F.unix_millis(F.col("ts").cast("timestamp"))
        return self._facts("events").select(
            "event_id",
            F.col("user_id"),
            "event_type",
            "value",
            once(F.get_json_object("props", "$.k").cast("int")).alias("k"),
            ms.alias("ts"),
            times.millis_to_time(ms).alias("event_time"),
        )

    @cached_property
    def pages(self) -> DataFrame:
        """Page logs; ``event_id`` breaks ties of time."""
        area = {"ar": F.col("c_nationkey").cast("string")}
        return self._pages(lookup(self.events, self._static("customer"), [("user_id", "c_custkey")], area))

    @cached_property
    def pages_anywhere(self) -> DataFrame:
        """Page logs without their area, for what does not look at it: no join for it."""
        return self._pages(self.events.withColumn("ar", F.lit(None).cast("string")))

    def with_area(self, rows: DataFrame) -> DataFrame:
        """Fill ``ar`` from the nation of the customer that is the device."""
        area = {"ar": F.col("c_nationkey").cast("string")}
        return lookup(rows, self._static("customer"), [("mid", "c_custkey")], area)

    @staticmethod
    def _pages(events: DataFrame) -> DataFrame:
        page = F.create_map(*[F.lit(x) for pair in PAGE_OF_EVENT.items() for x in pair])
        k = F.col("k")
        shown = F.array(
            F.struct(k.cast("string").alias("item"), F.lit("sku_id").alias("item_type")),
            F.struct((k + 1).cast("string").alias("item"), F.lit("activity_id").alias("item_type")),
        )
        return events.select(
            "event_id",
            F.col("user_id").cast("string").alias("mid"),
            (k % 3).cast("string").alias("vc"),
            F.col("event_type").alias("ch"),
            "ar",
            F.when(k < 50, "1").otherwise("0").alias("is_new"),
            page[F.col("event_type")].alias("page_id"),
            F.when(k % 2 == 1, "home").alias("last_page_id"),
            k.cast("string").alias("item"),
            F.floor("value").cast("bigint").alias("during_time"),
            F.when(F.col("event_type") == "view", shown).alias("display"),
            "ts",
            "event_time",
        )

    @cached_property
    def raw_logs(self) -> DataFrame:
        """The page logs as encoded JSON text; signups as start logs.

        Beside those with ``k = 13`` stands a broken copy, cut short.
        """
        is_start = F.col("ch") == "signup"
        # what devices send besides: braces in a text, an object, more about an item
        device = [F.lit("x{1}").alias("md"), F.struct(F.lit(1).alias("v")).alias("os")]
        item = F.transform(
            "display",
            lambda d, i: F.struct(
                d["item"].alias("item"), d["item_type"].alias("item_type"), F.lit("query").alias("display_type"), i.alias("order")
            ),
        )
        text = F.to_json(
            F.struct(
                F.struct("mid", "vc", *device, "ch", "ar", "is_new").alias("common"),
                F.when(~is_start, F.struct("page_id", "last_page_id", "item", "during_time")).alias("page"),
                F.when(is_start, F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
                item.alias("display"),
                "ts",
            )
        )
        texts = F.when(F.col("item") == "13", F.array(text, F.substring(text, 1, 20))).otherwise(F.array(text))
        return self.pages.select(F.explode(texts).alias("text")).select(F.url_encode("text").alias("value"))

    @cached_property
    def carts(self) -> DataFrame:
        return self._about_product("click")

    @cached_property
    def favors(self) -> DataFrame:
        return self._about_product("signup")

    @cached_property
    def comments(self) -> DataFrame:
        good = F.when(F.col("k") >= 50, F.lit(schemas.APPRAISE_GOOD)).otherwise(F.lit("1203"))
        return self._about_product("purchase", good.alias("appraise"))

    def _about_product(self, event_type: str, *more: Column) -> DataFrame:
        rows = self.events.where(F.col("event_type") == event_type)
        return rows.select(F.col("k").cast("bigint").alias("sku_id"), "event_time", *more)

    @cached_property
    def changes(self) -> DataFrame:
        """Change records in order of ``seq``; some without table, payload or enough fields."""
        k = F.col("k")
        fields = [
            F.lit("event_id"), F.col("event_id").cast("string"),
            F.lit("user_id"), F.col("user_id").cast("string"),
            F.lit("value"), F.col("value").cast("decimal(18,2)").cast("string"),
            F.lit("ts"), F.col("ts").cast("string"),
        ]
        digit = k % 10
        data = (
            F.when(digit == 9, F.lit(None))
            .when(digit == 8, F.create_map(*fields[:4]))
            .when(digit == 7, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
            .otherwise(F.create_map(*fields))
        )
        kind = F.when(k % 4 == 0, "insert").when(k % 4 == 1, "update").when(k % 4 == 2, "delete")
        return self.events.select(
            F.when(digit != 6, F.col("event_type")).alias("table"),
            kind.otherwise(F.lit("bootstrap-insert")).alias("type"),
            data.alias("data"),
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def routing(self) -> DataFrame:
        return self.spark.createDataFrame(ROUTES, schemas.ROUTING)

    # orders

    @cached_property
    def orders(self) -> DataFrame:
        """Orders; their province comes with ``with_province``, after the joins that cut rows."""
        time = F.col("o_orderdate").cast("timestamp")
        return self._facts("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderstatus").alias("order_status"),
            _money("o_totalprice").alias("total_amount"),
            times.time_to_text(time).alias("create_time"),
            time.alias("event_time"),
        )

    def with_province(self, rows: DataFrame) -> DataFrame:
        """Fill ``province_id`` from the nation of the customer."""
        area = {"province_id": F.col("c_nationkey").cast("bigint")}
        return lookup(rows, self._static("customer"), [("user_id", "c_custkey")], area)

    @cached_property
    def details(self) -> DataFrame:
        time = F.col("l_shipdate").cast("timestamp")
        return self._facts("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            _money("l_extendedprice").alias("order_price"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.concat(F.lit("sku "), F.col("l_partkey").cast("string")).alias("sku_name"),
            times.time_to_text(time).alias("create_time"),
            _money("l_extendedprice").alias("split_total_amount"),
            _money("l_discount").alias("split_activity_amount"),
            _money("l_tax").alias("split_coupon_amount"),
            time.alias("event_time"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per order, called back at its first shipping date."""
        per_order = self._facts("lineitem").groupBy("l_orderkey").agg(
            F.min(F.col("l_shipdate").cast("timestamp")).alias("event_time"),
            F.sum(_money("l_extendedprice")).cast("decimal(18,2)").alias("total_amount"),
            F.min("l_suppkey").alias("user_id"),
        )
        text = times.time_to_text(F.col("event_time"))
        return per_order.select(
            F.col("l_orderkey").alias("id"),
            F.col("l_orderkey").alias("order_id"),
            "user_id",
            "total_amount",
            F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("subject"),
            F.lit("1101").alias("payment_type"),
            text.alias("create_time"),
            text.alias("callback_time"),
            "event_time",
        )

    @cached_property
    def refunds(self) -> DataFrame:
        rows = self._facts("lineitem").where("l_returnflag = 'R'")
        return rows.select(
            F.col("l_partkey").alias("sku_id"),
            F.col("l_orderkey").alias("order_id"),
            _money("l_extendedprice").alias("refund_amount"),
            F.col("l_shipdate").cast("timestamp").alias("event_time"),
        )

    # dimensions

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        part = self._static("part")
        kind = F.ascii("p_type") * 100 + F.length("p_type")
        brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
        nation = self._static("nation")
        region = self._static("region")
        return {
            "user": self._static("customer").select(
                F.col("c_custkey").cast("string").alias("ID"),
                F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")).cast("string").alias("BIRTHDAY"),
                F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("GENDER"),
            ),
            "province": nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
                F.col("n_nationkey").cast("string").alias("ID"),
                F.col("n_name").alias("NAME"),
                F.concat(F.lit("CN-"), F.col("n_nationkey").cast("string")).alias("ISO_3166_2"),
                F.col("r_name").alias("ISO_CODE"),
                F.col("n_regionkey").cast("string").alias("AREA_CODE"),
            ),
            "sku": part.select(
                F.col("p_partkey").cast("string").alias("ID"),
                F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("SKU_NAME"),
                F.floor(F.col("p_partkey") / 10).cast("string").alias("SPU_ID"),
                brand.alias("TM_ID"),
                kind.cast("string").alias("CATEGORY3_ID"),
            ),
            "spu": part.groupBy(F.floor(F.col("p_partkey") / 10).cast("string").alias("ID")).agg(F.min("p_name").alias("SPU_NAME")),
            "category3": part.groupBy(kind.cast("string").alias("ID")).agg(F.min("p_type").alias("NAME")),
            "trademark": part.groupBy(brand.alias("ID")).agg(F.min("p_brand").alias("TM_NAME")),
        }

    @property
    def documents(self) -> DataFrame:
        return self._static("documents")

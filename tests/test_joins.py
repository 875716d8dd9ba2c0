import random
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.operators import joins, wide


def orders(spark, rows):
    return spark.createDataFrame(rows, "k bigint, t bigint").select("k", F.timestamp_millis("t").alias("order_time"), "t")


def details(spark, rows):
    return spark.createDataFrame(rows, "dk bigint, dt bigint").select(
        "dk", F.timestamp_millis("dt").alias("detail_time"), "dt"
    )


def pairs(df):
    return sorted((r.k, r.t, r.dt) for r in df.collect())


def five_seconds(left, right, slices=60):
    return joins.interval_join(left, right, [("k", "dk")], "order_time", "detail_time", "5 seconds", "5 seconds", slices)


def test_both_ends_of_the_interval_count(spark):
    got = five_seconds(
        orders(spark, [(1, 10_000)]),
        details(spark, [(1, 4_999), (1, 5_000), (1, 15_000), (1, 15_001), (2, 10_000)]),
    )
    assert pairs(got) == [(1, 10_000, 5_000), (1, 10_000, 15_000)]


row = st.tuples(st.integers(1, 3), st.integers(0, 40).map(lambda s: s * 500))


@settings(max_examples=10, deadline=None)
@given(st.lists(row, min_size=1, max_size=20), st.lists(row, min_size=1, max_size=20), st.sampled_from([1, 2, 60]))
def test_interval_join_equals_a_loop(spark, left, right, slices):
    expected = sorted((k, t, dt) for k, t in left for dk, dt in right if k == dk and t - 5_000 <= dt <= t + 5_000)
    assert pairs(five_seconds(orders(spark, left), details(spark, right), slices)) == expected


def test_a_hot_key_is_split_over_tasks(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        many = spark.range(0, 120_000, 1, 16).selectExpr(
            "IF(id % 3 = 0, 7, id) AS dk", "timestamp_millis(1000) AS detail_time", "id AS dt"
        )
        one = spark.range(0, 120_000, 1, 4).selectExpr("id AS k", "timestamp_millis(1000) AS order_time", "id AS t")
        joined = five_seconds(one, many)
        # as in the jobs: aggregated by something else afterwards
        counted = joined.groupBy((F.col("dt") % 5).alias("g")).count()
        assert sum(r["count"] for r in counted.collect()) == 120_000
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_on_both_sides_meets_only_its_neighbours(spark):
    """Every row has the same key; all pairs would be a hundred million."""
    left = orders(spark, [(1, i * 60_000) for i in range(10_000)])
    right = details(spark, [(1, i * 60_000 + 4_000) for i in range(10_000)])
    joined = five_seconds(left, right)
    assert joined.count() == 10_000
    assert "_right_slice" in joined._jdf.queryExecution().executedPlan().toString()


def test_lookup_keeps_misses_and_replaces_on_a_hit(spark):
    facts = spark.createDataFrame([(1, "own"), (2, "own"), (None, "own")], "sku_id bigint, sku_name string")
    dim = spark.createDataFrame([("1", None, "x")], "ID string, SKU_NAME string, EXTRA string")
    got = joins.lookup(facts, dim, [("sku_id", "ID")], {"sku_name": F.col("SKU_NAME"), "extra": F.col("EXTRA")})
    assert sorted(map(tuple, got.collect()), key=str) == [(1, None, "x"), (2, "own", None), (None, "own", None)]


def test_lookup_by_two_keys(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "b")], "x bigint, y string")
    dim = spark.createDataFrame([("1", "b", "hit")], "K1 string, K2 string, V string")
    got = joins.lookup(facts, dim, [("x", "K1"), ("y", "K2")], {"v": F.col("V")})
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (1, "b", "hit")]


def test_only_sides_of_a_known_small_size_are_broadcast(spark):
    facts = spark.range(10).withColumnRenamed("id", "x")
    dim = spark.range(1000).selectExpr("CAST(id AS STRING) AS ID", "id AS v")

    def plan(limit):
        joined = joins.lookup(facts, dim, [("x", "ID")], {"v": F.col("v")}, limit)
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "rightHint=(strategy=broadcast)" in plan(10**6)
    assert "broadcast" not in plan(10)


def test_first_row_per_key(spark):
    rows = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only")], "k string, n int, v string")
    got = joins.first_per_key(rows, ["k"], ["n"])
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", "early"), ("b", "only")]


# wide facts


def money(text):
    return Decimal(text)


def order_rows(spark):
    rows = [(1, 5, "1001", 9, money("100.00"), "2024-01-01 10:00:00", "2024-01-01 11:00:00")]
    df = spark.createDataFrame(
        rows,
        "id bigint, province_id bigint, order_status string, user_id bigint, total_amount decimal(18,2), "
        "create_time string, operate_time string",
    )
    return df.withColumn("event_time", times.text_to_time(F.col("create_time")))


def detail_rows(spark):
    rows = [
        (11, 1, 100, 2, money("60.00"), "a", "2024-01-01 10:00:05"),
        (12, 1, 101, 1, money("40.00"), "b", "2024-01-01 10:00:06"),
    ]
    df = spark.createDataFrame(
        rows,
        "id bigint, order_id bigint, sku_id bigint, sku_num bigint, split_total_amount decimal(18,2), "
        "sku_name string, create_time string",
    )
    return df.withColumn("event_time", times.text_to_time(F.col("create_time")))


def test_lines_of_the_same_day_outside_the_interval_do_not_join(spark):
    got = wide.order_wide(order_rows(spark), detail_rows(spark)).collect()
    assert [(r.detail_id, r.create_date, r.create_hour, r.operate_time) for r in got] == [
        (11, "2024-01-01", "10", "2024-01-01 11:00:00")
    ]
    assert got[0].split_feight_fee is None


def test_wide_columns_are_those_of_the_schema(spark):
    got = wide.order_wide(order_rows(spark), detail_rows(spark))
    assert got.columns == [*schemas.column_names(schemas.ORDER_WIDE), "event_time"]


def test_payment_wins_over_the_order(spark):
    pay = spark.createDataFrame(
        [
            (7, 1, 99, money("1.00"), "s", "1101", "2024-01-01 10:10:00", "2024-01-01 10:30:00"),
            (8, 1, 99, money("1.00"), "s", "1101", "2024-01-01 10:10:00", "2024-01-01 10:30:01"),
            (9, 1, 99, money("1.00"), "s", "1101", "2024-01-01 09:59:59", "2024-01-01 09:59:59"),
        ],
        "id bigint, order_id bigint, user_id bigint, total_amount decimal(18,2), subject string, "
        "payment_type string, create_time string, callback_time string",
    ).withColumn("event_time", times.text_to_time(F.col("callback_time")))
    got = wide.payment_wide(pay, wide.order_wide(order_rows(spark), detail_rows(spark))).collect()
    assert [(r.payment_id, r.detail_id, r.user_id, r.total_amount) for r in got] == [(7, 11, 99, money("1.00"))]
    assert got[0].payment_create_time == "2024-01-01 10:10:00"
    assert got[0].order_create_time == "2024-01-01 10:00:00"


def test_fill_gaps_equals_full_join_and_coalesce(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, 5)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "y", 7), (3, "z", None)], "k int, s string, n int")
    got = sorted(tuple(r) for r in wide.fill_gaps(a, b, ["k"]).collect())
    assert got == [(1, "x", 7), (2, None, 5), (3, "z", None)]


def test_numbers_as_text_are_read(spark):
    raw = spark.createDataFrame(
        [('{"id":"3","order_id":4,"sku_num":"x","split_total_amount":"1.50","create_time":"2024-01-01 00:00:00"}',)],
        "value string",
    )
    row = wide.typed(raw, schemas.ORDER_DETAIL).first()
    assert (row.id, row.order_id, row.sku_num, row.split_total_amount) == (3, 4, None, money("1.50"))


def test_slices_by_density_spread_a_hot_key_and_change_nothing(spark):
    dice = random.Random(2)
    day = 86_400
    left = spark.createDataFrame([(0 if i % 3 else i, dice.randrange(300) * day, i) for i in range(300)], "k int, t bigint, nr int")
    right = spark.createDataFrame([(0 if i % 3 else i, dice.randrange(300) * day, i) for i in range(900)], "rk int, rt bigint, rnr int")
    left = left.withColumn("t", F.timestamp_seconds("t"))
    right = right.withColumn("rt", F.timestamp_seconds("rt"))
    edges = joins.quantile_edges(right, "rt", 8)
    assert len(edges) == 7

    def joined(edges):
        return joins.interval_join(left, right, [("k", "rk")], "t", "rt", "30 days", "30 days", edges=edges)

    expected = sorted((r.nr, r.rnr) for r in joined(None).collect())
    assert len(expected) > 1000
    for some in (edges, [], [0], edges[:1]):
        assert sorted((r.nr, r.rnr) for r in joined(some).collect()) == expected
    # rows of the hot key that are compared with each other: one slice of eight, or all
    sliced = right.select(F.size(F.filter(F.lit(edges), lambda e: e <= F.unix_millis("rt"))).alias("s")).groupBy("s").count()
    assert max(r["count"] for r in sliced.collect()) < 900 / 8 * 1.5

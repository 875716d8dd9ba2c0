import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace import schemas
from millrace.operators import changes
from millrace.sinks.dimensions import DimensionTables, create_table_sql
from millrace.sources.routing import dimension_routes, load_routing

ROUTES = [
    ("user", "insert", "HBase", "dim_user", "id,name,tel", None, None),
    ("user", "update", "hbase", "dim_user", "id,name,tel", None, None),
    ("brand", "insert", "hbase", "dim_brand", "tm_id,tm_name", "tm_id", "CLUSTERED BY (tm_id) INTO 3 BUCKETS"),
    ("order", "insert", "kafka", "dwd_order", "id,total", None, None),
    ("order", "update", "KAFKA", "dwd_order_update", "", None, None),
    ("order", "delete", "clickhouse", "nowhere", None, None, None),
]


def routing(spark, rows=ROUTES):
    return load_routing(spark.createDataFrame(rows, schemas.ROUTING))


def records(spark, *rows):
    texts = [
        (i, json.dumps({k: v for k, v in (("table", t), ("type", k), ("data", d)) if v is not None}))
        for i, (t, k, d) in enumerate(rows)
    ]
    return changes.parse_changes(spark.createDataFrame(texts, "seq bigint, value string"))


def test_records_without_table_payload_or_fields_are_dropped(spark):
    full = {"id": 1, "a": 2, "b": 3}
    got = changes.usable_changes(
        records(spark, (None, "insert", full), ("t", "insert", None), ("t", "insert", {"id": 1, "a": 2}), ("t", "insert", full))
    )
    assert [r.seq for r in got.collect()] == [3]


def test_bulk_load_counts_as_insert(spark):
    got = changes.normalise_type(records(spark, ("t", "bootstrap-insert", {}), ("t", "update", {})))
    assert sorted(r.type for r in got.collect()) == ["insert", "update"]


def test_routes_by_table_and_type_ignoring_case_of_the_sink(spark):
    full = {"id": 1, "name": "n", "tel": "t", "total": 9}
    routed = changes.route_changes(
        records(
            spark,
            ("user", "bootstrap-insert", full),
            ("order", "insert", full),
            ("order", "update", full),
            ("order", "delete", full),
            ("cart", "insert", full),
        ),
        routing(spark),
    )
    facts = {r.topic: json.loads(r.value) for r in changes.fact_messages(routed).collect()}
    assert facts == {
        "DWD_ORDER": {"id": "1", "total": "9"},
        "DWD_ORDER_UPDATE": {"id": "1", "name": "n", "tel": "t", "total": "9"},
    }
    dims = changes.dimension_changes(routed).collect()
    assert [(r.sink_table, r.sink_pk, r.data) for r in dims] == [
        ("DIM_USER", "id", {"id": "1", "name": "n", "tel": "t"})
    ]


def test_a_payload_without_wanted_fields_is_no_dimension_row(spark):
    routed = changes.route_changes(records(spark, ("user", "insert", {"x": 1, "y": 2, "z": 3})), routing(spark))
    assert routed.count() == 1
    assert changes.dimension_changes(routed).count() == 0


def test_an_empty_or_ambiguous_routing_table_is_an_error(spark):
    with pytest.raises(ValueError, match="empty"):
        routing(spark, [])
    with pytest.raises(ValueError, match="two rows"):
        routing(spark, [ROUTES[0], ROUTES[0]])


def test_dimension_tables_of_the_routing(spark):
    got = {r["table"]: (r["columns"], r["key"]) for r in dimension_routes(routing(spark))}
    assert got == {"DIM_USER": ("id,name,tel", "id"), "DIM_BRAND": ("tm_id,tm_name", "tm_id")}


def test_create_table_from_routing(spark):
    sql = create_table_sql("DIM_BRAND", "tm_id,tm_name", "tm_id", "CLUSTERED BY (tm_id) INTO 3 BUCKETS")
    assert sql == (
        "CREATE TABLE IF NOT EXISTS DIM_BRAND (`tm_id` STRING NOT NULL, `tm_name` STRING) USING parquet "
        "CLUSTERED BY (tm_id) INTO 3 BUCKETS"
    )


def test_the_statement_runs(spark, tmp_path):
    spark.sql(create_table_sql("dim_t", "id,name", None, f"LOCATION '{tmp_path}'"))
    spark.sql(create_table_sql("dim_t", "id,name", None, f"LOCATION '{tmp_path}'"))
    assert spark.table("dim_t").dtypes == [("id", "string"), ("name", "string")]
    spark.sql("DROP TABLE dim_t")


def applied(spark, rows, **options):
    frame = spark.createDataFrame(rows, "seq bigint, type string, data map<string,string>")
    got = changes.apply_changes(frame, "id", ["id", "name", "tel"], "seq", **options)
    return sorted(tuple(r) for r in got.collect())


def test_latest_value_wins_per_column(spark):
    rows = [
        (1, "insert", {"id": "1", "name": "a", "tel": "t"}),
        (3, "update", {"id": "1", "name": "it's"}),
        (2, "update", {"id": "1", "name": "b", "tel": None}),
    ]
    assert applied(spark, rows) == [("1", "it's", None)]


def test_delete_removes_and_a_later_insert_starts_anew(spark):
    rows = [
        (1, "insert", {"id": "1", "name": "a", "tel": "t"}),
        (2, "delete", {"id": "1", "name": "a", "tel": "t"}),
        (1, "insert", {"id": "2", "name": "a", "tel": "t"}),
        (2, "delete", {"id": "2"}),
        (3, "insert", {"id": "2", "name": "c"}),
    ]
    assert applied(spark, rows) == [("2", "c", None)]
    assert applied(spark, rows, deletes=False) == [("1", "a", "t"), ("2", "c", "t")]


change = st.tuples(
    st.sampled_from(["insert", "update", "delete"]),
    st.sampled_from("12"),
    st.dictionaries(st.sampled_from(["name", "tel"]), st.one_of(st.none(), st.sampled_from("xyz"))),
)


@settings(max_examples=12, deadline=None)
@given(st.lists(change, min_size=1, max_size=25))
def test_apply_changes_equals_a_loop(spark, rows):
    table, typed = {}, []
    for seq, (kind, key, fields) in enumerate(rows):
        typed.append((seq, kind, {"id": key, **fields}))
        if kind == "delete":
            table.pop(key, None)
        else:
            table.setdefault(key, {"name": None, "tel": None}).update(fields)
    expected = sorted((k, v["name"], v["tel"]) for k, v in table.items())
    assert sorted(applied(spark, typed), key=str) == sorted(expected, key=str)


def test_tables_merge_batch_by_batch_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    tables = DimensionTables(spark, str(tmp_path))
    schema = changes.dimension_schema("id,name")

    def merge(*rows):
        frame = spark.createDataFrame(list(rows), "seq bigint, type string, data map<string,string>")
        tables.merge("DIM_T", ["id", "name"], "id", frame)

    def rows():
        return sorted(tuple(r) for r in tables.read("DIM_T", schema).collect())

    assert rows() == []
    merge((0, "insert", {"id": "1", "name": "a"}), (1, "insert", {"id": "2", "name": "b"}))
    merge((2, "delete", {"id": "1"}), (3, "update", {"id": "2", "name": "c"}))
    assert rows() == [("2", "c")]
    merge((2, "delete", {"id": "1"}), (3, "update", {"id": "2", "name": "c"}))
    assert rows() == [("2", "c")]
    # batches counted from 0 again, with a store that knows nothing of the earlier ones
    tables = DimensionTables(spark, str(tmp_path))
    merge((0, "insert", {"id": "3", "name": "d"}))
    assert rows() == [("2", "c"), ("3", "d")]


def test_only_touched_buckets_are_written_and_readers_keep_theirs(spark, tmp_path):
    tables = DimensionTables(spark, str(tmp_path))
    schema = changes.dimension_schema("id,name")

    def frame(rows):
        return spark.createDataFrame([(seq, "insert", {"id": str(i), "name": name}) for seq, i, name in rows], "seq bigint, type string, data map<string,string>")

    written = tables.merge("DIM_T", ["id", "name"], "id", frame((i, i, "a") for i in range(500)), extend="SALT_BUCKETS = 16")
    assert written == list(range(16))  # the extra clause says how many buckets
    before = tables.read("DIM_T", schema)
    folders = tables.store("DIM_T").manifest()["buckets"]
    (touched,) = tables.merge("DIM_T", ["id", "name"], "id", frame([(900, 7, "b")]))
    after = tables.store("DIM_T").manifest()["buckets"]
    assert [b for b in after if after[b] != folders[b]] == [str(touched)]
    # who began to read before goes on with what was there
    assert before.where("id = '7'").first()["name"] == "a"
    assert tables.read("DIM_T", schema).where("id = '7'").first()["name"] == "b"
    assert tables.read("DIM_T", schema).count() == 500
    # versions that nobody needs any more go, with their files
    for i in range(5):
        tables.merge("DIM_T", ["id", "name"], "id", frame([(901 + i, 7, f"c{i}")]))
    assert len(tables.store("DIM_T").versions()) == 3
    assert len(tables.store("DIM_T").files.names("data")) <= 4
    assert tables.store("DIM_T").manifest()["extend"] == "SALT_BUCKETS = 16"


def test_a_change_of_a_later_batch_loses_to_a_newer_one_column_by_column(spark, tmp_path):
    tables = DimensionTables(spark, str(tmp_path))

    def merge(*rows):
        frame = spark.createDataFrame(list(rows), "seq bigint, type string, data map<string,string>")
        tables.merge("DIM_T", ["id", "name", "tel"], "id", frame)

    merge((10, "insert", {"id": "1", "name": "new"}))
    merge((5, "update", {"id": "1", "name": "old", "tel": "7"}))
    assert tables.latest("DIM_T").collect() == [("1", "new", "7")]
    merge((7, "update", {"id": "1", "tel": "8", "name": "older"}))
    assert tables.latest("DIM_T").collect() == [("1", "new", "8")]


def test_changes_are_in_one_order_over_all_partitions(spark):
    def record(kind, name, **more):
        return json.dumps({"table": "user", "type": kind, "data": {"id": "1", "name": name, "x": "0"}, **more})

    def current(*rows):
        raw = spark.createDataFrame(list(rows), "value string, partition int, offset bigint")
        ordered = changes.order_of_changes(changes.parse_changes(raw))
        return changes.apply_changes(ordered, "id", ["id", "name"], "seq").first()["name"]

    assert current((record("insert", "a", ts=100), 0, 900), (record("update", "b", ts=101), 1, 5)) == "b"
    assert current((record("insert", "a", ts=100, xid=9, xoffset=1), 0, 1), (record("update", "b", ts="100", xid="9", xoffset=0), 0, 2)) == "a"
    assert current((record("insert", "a"), 0, 1), (record("update", "b"), 0, 2)) == "b"


def test_tables_of_a_batch_are_merged_together(spark, tmp_path):
    tables = DimensionTables(spark, str(tmp_path))
    routes = [{"table": f"DIM_{i}", "columns": "id,v" if i else "k,v", "key": "id" if i else "k", "extend": ""} for i in range(12)]
    rows = [(f"DIM_{i}", "insert", {"id" if i else "k": str(j), "v": "x"}, j) for i in range(0, 12, 2) for j in range(3)]
    batch = spark.createDataFrame(rows, "sink_table string, type string, data map<string,string>, seq bigint")
    done = tables.merge_all(routes, batch)
    assert sorted(done) == sorted(f"DIM_{i}" for i in range(0, 12, 2))
    for i in range(12):
        assert tables.latest(f"DIM_{i}").count() == (0 if i % 2 else 3)

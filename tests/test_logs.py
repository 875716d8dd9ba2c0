import json
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import logs

DAY = 86_400_000


def log(mid="m1", is_new="1", ts=10_000, page=None, start=None, display=None, **more):
    common = {"mid": mid, "vc": "v1", "ch": "web", "ar": "110000", "is_new": is_new}
    body = {"common": common, "ts": ts, **more}
    if page is not None:
        body["page"] = page
    if start is not None:
        body["start"] = start
    if display is not None:
        body["display"] = display
    return json.dumps(body)


def raw(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_encoded_text_is_decoded_and_bad_rows_are_dropped(spark):
    good = quote(log(page={"page_id": "首页", "during_time": 7}))
    rows = logs.parse_logs(raw(spark, good, "%zz", quote("{cut"), quote("not json"), None)).collect()
    assert [(r.mid, r.page_id, r.during_time, r.ts) for r in rows] == [("m1", "首页", 7, 10_000)]


def test_numbers_sent_as_text_are_accepted(spark):
    text = log(ts="10000", page={"page_id": "home", "during_time": "12", "item": 5})
    row = logs.parse_logs(raw(spark, text), encoded=False).first()
    assert (row.ts, row.during_time, row.item) == (10_000, 12, "5")


def test_text_is_decoded_and_parsed_once_per_row(spark):
    rows = logs.page_logs(logs.parse_logs(raw(spark, log()).repartition(2))).where("is_new = '1' AND ts > 0")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert plan.count("UrlCodec.decode") == 1


def test_split_by_non_empty_start(spark):
    rows = logs.parse_logs(
        raw(
            spark,
            log("a", start={"entry": "icon"}),
            log("b", start={}, page={"page_id": "home"}),
            log("c", page={"page_id": "home"}),
        ),
        encoded=False,
    )
    assert {r.mid for r in logs.start_logs(rows).collect()} == {"a"}
    assert {r.mid for r in logs.page_logs(rows).collect()} == {"b", "c"}


def test_one_row_per_display_with_its_page(spark):
    shown = [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "activity_id"}]
    rows = logs.parse_logs(
        raw(spark, log(page={"page_id": "home"}, display=shown), log(page={"page_id": "cart"}, display=[])),
        encoded=False,
    )
    got = [(r.page_id, r.item, r.item_type) for r in logs.display_rows(rows).collect()]
    assert sorted(got) == [("home", "1", "sku_id"), ("home", "2", "activity_id")]


def test_displays_keep_all_that_was_sent(spark):
    shown = [{"item": 7, "order": 3, "more": {"a": [1, None, "x}"]}, "page_id": "other"}, {}]
    rows = logs.parse_logs(raw(spark, log(page={"page_id": "home"}, display=shown)), encoded=False, keep=["value"])
    got = [(r.item, json.loads(r.fields)) for r in logs.display_rows(rows).collect()]
    kept = {"item": 7, "order": 3, "more": {"a": [1, None, "x}"]}, "page_id": "home"}
    assert ("7", kept) in got and (None, {"page_id": "home"}) in got


def test_flag_is_repaired_on_a_later_date_only(spark):
    rows = logs.parse_logs(
        raw(spark, log(ts=0), log(ts=5), log(ts=DAY), log(ts=DAY + 1, is_new="0"), log("m2", ts=DAY)), encoded=False
    )
    got = {(r.mid, r.ts): r.is_new for r in logs.repair_new_visitors(rows).collect()}
    assert got == {("m1", 0): "1", ("m1", 5): "1", ("m1", DAY): "0", ("m1", DAY + 1): "0", ("m2", DAY): "1"}


def test_text_for_the_next_layer_keeps_unknown_fields(spark):
    text = log(ts=DAY, extra={"is_new": "1", "deep": [1, {"x": None}]})
    rows = logs.repair_new_visitors(logs.parse_logs(raw(spark, log(ts=0), text), encoded=False))
    written = sorted((json.loads(r.value) for r in logs.log_text(rows).collect()), key=lambda o: o["ts"])
    assert [o["common"]["is_new"] for o in written] == ["1", "0"]
    assert written[1]["extra"] == {"is_new": "1", "deep": [1, {"x": None}]}


visit = st.tuples(st.sampled_from("ab"), st.sampled_from(["0", "1", None]), st.integers(0, 5 * DAY))


@settings(max_examples=12, deadline=None)
@given(st.lists(visit, min_size=1, max_size=30, unique_by=lambda v: v[2]))
@pytest.mark.filterwarnings("ignore")
def test_repair_equals_a_loop(spark, rows):
    first, expected = {}, set()
    for mid, is_new, ts in sorted(rows, key=lambda v: v[2]):
        if is_new == "1":
            day = ts // DAY
            is_new = "1" if first.setdefault(mid, day) == day else "0"
        expected.add((mid, is_new, ts))
    frame = spark.createDataFrame(rows, "mid string, is_new string, ts bigint")
    assert {tuple(r) for r in logs.repair_new_visitors(frame).collect()} == expected


ANY = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", "1", 'a"b', "x{1}", "}]", "\\", "is_new", "common", "é\n"]),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["is_new", "common", "os", 'q"', "a"]), inner, max_size=3),
    max_leaves=12,
)
NAMES = st.sampled_from(["os", "loc", "page", "md", 'k"', "z"])
SPACE = st.sampled_from(["", " ", "\n\t "])


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.lists(st.tuples(NAMES, ANY), max_size=3), st.lists(st.tuples(NAMES, ANY), max_size=3),
            st.lists(st.tuples(NAMES, ANY), max_size=3), st.lists(st.tuples(NAMES, ANY), max_size=3),
            SPACE, st.sampled_from(['"1"', "1", '"0"', '"2"', "true"]), st.sampled_from(['"is_new"', '"\\u0069s_new"']), st.booleans(),
        ),
        min_size=1, max_size=8,
    )
)
def test_only_the_flag_in_common_is_written_anew(spark, cases):
    rows, expected = [], []
    for before, inner_before, inner_after, after, space, value, name, returning in cases:
        def members(pairs):
            return [f"{space}{json.dumps(k)}{space}:{space}{json.dumps(v, ensure_ascii=False)}" for k, v in pairs]

        def text(flag):
            inner = ",".join([*members(inner_before), f"{space}{name}{space}:{space}{flag}", *members(inner_after)])
            return "{" + ",".join([*members(before), f'{space}"common":{space}{{{inner}{space}}}', *members(after)]) + "}"

        rows.append(("0" if returning else "1", text(value)))
        expected.append(text('"0"' if returning and value in ('"1"', "1") else value))
    got = logs.log_text(spark.createDataFrame(rows, "is_new string, body string").coalesce(1)).collect()
    assert [r.value for r in got] == expected


def test_displays_keep_what_is_sent_and_their_page(spark):
    items = [{"item": "1", "item_type": "sku_id", "x": {"a": [1, None]}}, {"page_id": "own", "item": 2}, {}]
    body = {"common": {"mid": "a"}, "page": {"page_id": 'h"é'}, "display": items, "ts": 5}
    rows = [(quote(json.dumps(body)),), (quote(json.dumps({**body, "display": []})),), (quote(json.dumps({**body, "display": None})),)]
    found = logs.display_rows(logs.parse_logs(spark.createDataFrame(rows, "value string"))).collect()
    assert [(r["item"], r["item_type"]) for r in found] == [("1", "sku_id"), ("2", None), (None, None)]
    assert [json.loads(r["fields"]) for r in found] == [{**i, "page_id": 'h"é'} for i in items]

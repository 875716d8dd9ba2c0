import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import times, words
from millrace.operators import keywords

PHONE = "Apple iPhoneXSMax (A2104) 256GB 深空灰色 移动联通电信4G手机 双卡双待"
TERMS = ["深空", "灰色", "移动", "联通", "电信", "手机", "双卡", "双待", "移动联通"]


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")


def split(df, terms=()):
    return [r.keyword for r in keywords.split_keywords(df, "text", terms).collect()]


def test_latin_runs_in_lower_case_and_chinese_pairs(spark):
    got = split(texts(spark, PHONE))
    assert got[:7] == ["apple", "iphonexsmax", "a2104", "256gb", "深空", "空灰", "灰色"]
    assert "4g" in got


def test_terms_are_matched_longest_first(spark):
    got = split(texts(spark, PHONE), TERMS)
    assert got == [
        "apple", "iphonexsmax", "a2104", "256gb", "深空", "灰色", "移动联通", "电信", "4g", "手机", "双卡", "双待",
    ]


def test_dictionary_table_gives_the_same_words(spark):
    dictionary = spark.createDataFrame([(t,) for t in TERMS], "word string")
    df = texts(spark, PHONE, "手机手机壳", "no chinese", "壳", None, "", "深空手机移动联" * 40, PHONE)
    by_join = keywords.dictionary_keywords(df, "text", dictionary)
    by_terms = keywords.split_keywords(df, "text", TERMS)
    assert sorted(map(tuple, by_join.collect())) == sorted(map(tuple, by_terms.collect()))


def test_a_large_dictionary_is_joined_by_shuffle(spark):
    many = spark.range(200_000).selectExpr("concat('词', id) AS word")
    got = keywords.dictionary_keywords(texts(spark, "手机"), "text", many)
    assert "broadcast" in got._jdf.queryExecution().optimizedPlan().toString()
    before = keywords.broadcast_if_small
    keywords.broadcast_if_small = lambda df: before(df, 10)
    try:
        got = keywords.dictionary_keywords(texts(spark, "手机"), "text", many)
        assert "broadcast" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.keyword for r in got.collect()) == ["手", "机"]
    finally:
        keywords.broadcast_if_small = before


def test_text_without_words_gives_no_row(spark):
    assert split(texts(spark, "", "!!", None)) == []


def test_too_many_terms_are_refused():
    with pytest.raises(ValueError):
        words.words(F.lit("x"), [str(i) for i in range(words.MAX_INLINE_TERMS + 1)])


def test_counts_above_zero_become_rows(spark):
    df = spark.createDataFrame(
        [("a", 2, 0, 1), ("b", None, None, None), ("c", 0, 3, 0)],
        "k string, click_ct bigint, cart_ct bigint, order_ct bigint",
    )
    got = sorted(tuple(r) for r in keywords.counts_to_rows(df).collect())
    assert got == [("a", 1, "ORDER"), ("a", 2, "CLICK"), ("c", 3, "CART")]


def test_words_of_products_carry_the_counts(spark):
    df = spark.createDataFrame(
        [("Red Phone", 2, 0, 1, "s", "e"), ("Blue", 0, 0, 0, "s", "e")],
        "spu_name string, click_ct bigint, cart_ct bigint, order_ct bigint, stt string, edt string",
    )
    got = sorted((r.keyword, r.ct, r.source) for r in keywords.product_keywords(df).collect())
    assert got == [("phone", 1, "ORDER"), ("phone", 2, "CLICK"), ("red", 1, "ORDER"), ("red", 2, "CLICK")]


def test_searches_are_counted_per_window_with_its_end(spark):
    rows = [("good_list", "red phone", 0), ("good_list", "Red", 9_999), ("good_list", None, 1), ("home", "red", 1), ("good_list", "red", 10_000)]
    pages = spark.createDataFrame(rows, "page_id string, item string, ts bigint")
    pages = pages.withColumn("event_time", times.millis_to_time(F.col("ts")))
    found = keywords.split_keywords(keywords.search_terms(pages), "fullword")
    got = sorted((r.keyword, r.ct, r.source, r.stt[-8:], r.edt[-8:]) for r in keywords.keyword_stats(found).collect())
    assert got == [
        ("phone", 1, "SEARCH", "00:00:00", "00:00:10"),
        ("red", 1, "SEARCH", "00:00:10", "00:00:20"),
        ("red", 2, "SEARCH", "00:00:00", "00:00:10"),
    ]


def all_paths(text, dictionary):
    """All ways to split a text into words of the dictionary and single characters."""
    if not text:
        return [[]]
    sizes = {1} | {len(w) for w in dictionary if text.startswith(w)}
    return [[text[:s], *rest] for s in sizes for rest in all_paths(text[s:], dictionary)]


def test_the_best_path_is_that_of_all_paths(spark):
    dice = random.Random(5)
    dictionary = ["一二", "二三", "三四五", "一二三", "五五", "四五五一", "二一"]
    runs = ["".join(dice.choice("一二三四五") for _ in range(dice.randint(1, 9))) for _ in range(80)]
    expected = []
    for run in runs:
        expected += max(
            all_paths(run, dictionary), key=lambda p: (sum(len(w) for w in p if len(w) > 1), -len(p), [len(w) for w in p])
        )
    table = spark.createDataFrame([(w,) for w in dictionary], "word string")
    found = keywords.dictionary_keywords(texts(spark, *runs), "text", table, lattice=True)
    assert sorted(r.keyword for r in found.collect()) == sorted(expected)
    # and by the longest match from left to right
    greedy = keywords.dictionary_keywords(texts(spark, *runs), "text", table)
    assert sorted(r.keyword for r in greedy.collect()) == sorted(split(texts(spark, *runs), dictionary))


def test_a_run_of_a_hundred_thousand_characters(spark):
    table = spark.createDataFrame([("手机",), ("机手机",), ("移动联通",)], "word string")
    run = "手机壳" * 20_000 + "移动联通" * 10_000
    found = keywords.dictionary_keywords(texts(spark, run), "text", table, lattice=True).groupBy("keyword").count()
    assert {r["keyword"]: r["count"] for r in found.collect()} == {"手机": 20_000, "壳": 20_000, "移动联通": 10_000}


def test_each_task_of_the_split_has_few_characters(spark, monkeypatch):
    monkeypatch.setattr(keywords, "CHARACTERS_PER_TASK", 1_000)
    digits = "零一二三四五六七八九"
    numbers = [f"{i:04d}" for i in range(2_000)]
    df = texts(spark, *["".join(digits[int(d)] for d in n) + "手机" for n in numbers], None)
    dictionary = spark.createDataFrame([("手机",), ("一二",), ("二三四",), ("零零",)], "word string")
    for lattice in (False, True):
        found = keywords.dictionary_keywords(df, "text", dictionary, lattice)
        # 12,000 characters: what has a row per character is dealt over twelve tasks
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"RepartitionByExpression \[_id#\d+\], 12\b", plan)
        terms = ["手机", "一二", "二三四", "零零"]
        if not lattice:
            expected = sorted((r.id, r.keyword) for r in keywords.split_keywords(df, "text", terms).collect())
            assert sorted((r.id, r.keyword) for r in found.collect()) == expected
        else:
            assert found.where("keyword = '手机'").count() == 2_000

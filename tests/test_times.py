import pytest
from pyspark.sql import functions as F

from millrace.functions import times


@pytest.fixture
def shanghai(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, millis",
    [
        ("2018-04-01 10:00:01", 1522548001000),
        ("2018-04-02 11:00:02", 1522638002000),
        ("2018-04-03 12:00:03", 1522728003000),
        ("2018-04-04 13:00:04", 1522818004000),
        ("2018-04-05 14:00:05", 1522908005000),
    ],
)
def test_text_is_read_and_written_in_utc_plus_8(shanghai, text, millis):
    assert value(shanghai, times.text_to_millis(F.lit(text))) == millis
    assert value(shanghai, times.time_to_text(times.millis_to_time(F.lit(millis)))) == text


def test_dates_of_milliseconds(shanghai):
    late = F.lit(1522598400000)  # midnight in UTC+8, the day before in UTC
    assert value(shanghai, times.millis_to_day(late)) == "2018-04-02"
    assert value(shanghai, times.millis_to_compact_day(late)) == "20180402"


def test_day_precision_ignores_the_time(shanghai):
    whole = value(shanghai, times.text_to_day_millis(F.lit("2018-04-01 10:00:01")))
    assert whole == value(shanghai, times.text_to_millis(F.lit("2018-04-01 00:00:00")))


@pytest.mark.parametrize("birthday, age", [("1994-01-09", 30), ("1994-01-08", 30), ("1994-01-10", 29), ("2024-01-01", 0)])
def test_age_in_years_of_365_days(spark, birthday, age):
    as_of = F.lit("2024-01-02").cast("timestamp")
    assert value(spark, times.age_in_years(F.lit(birthday).cast("date"), as_of)) == age

"""Time expressions. Text is read and written in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_TEXT = "yyyy-MM-dd HH:mm:ss"
DAY_TEXT = "yyyy-MM-dd"
COMPACT_DAY_TEXT = "yyyyMMdd"

MILLIS_PER_DAY = 86_400_000


def millis_to_time(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def text_to_time(text: Column) -> Column:
    return F.to_timestamp(text, SECONDS_TEXT)


def text_to_millis(text: Column) -> Column:
    return F.unix_millis(text_to_time(text))


def text_to_day_millis(text: Column) -> Column:
    """Epoch milliseconds of the start of the day; the time of day is ignored."""
    return F.unix_millis(F.to_date(text).cast("timestamp"))


def time_to_text(time: Column) -> Column:
    return F.date_format(time, SECONDS_TEXT)


def millis_to_day(ms: Column) -> Column:
    return F.date_format(millis_to_time(ms), DAY_TEXT)


def millis_to_compact_day(ms: Column) -> Column:
    return F.date_format(millis_to_time(ms), COMPACT_DAY_TEXT)


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between two points in time."""
    days = (F.unix_millis(as_of.cast("timestamp")) - F.unix_millis(birthday.cast("timestamp"))) / MILLIS_PER_DAY
    return F.floor(days / 365).cast("int")


def window_bounds(window: str = "window") -> list[Column]:
    """Start and end of a window as text, named ``stt`` and ``edt``."""
    return [
        time_to_text(F.col(f"{window}.start")).alias("stt"),
        time_to_text(F.col(f"{window}.end")).alias("edt"),
    ]

"""The warehouse jobs, from topics of JSON text to topics of JSON text and to tables.

A job has two parts. ``core`` goes from frames with a ``value`` column, static or
streaming, to one frame; on a stream it holds all state. ``outputs`` turns that frame, or
one batch of it, into the outputs by name: ``value`` text for topics, typed rows for
tables. Dimensions are joined there, so a stream sees them as they are at each batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from millrace import schemas
from millrace.operators import changes, keywords, logs, order_stats, traffic, visits, wide
from millrace.streaming import watermarks
from millrace.streaming.clock import TopicClock
from millrace.streaming.first_seen import DailyVisits, FirstDays
from millrace.streaming.run import to_messages
from millrace.streaming.watermarks import with_event_time

Frames = Mapping[str, DataFrame]

# Where a record stands in its topic.
_PLACE = ("partition", "offset")


class LiveTopics(dict):
    """Topics by name, and the clock that keeps their watermarks over restarts."""

    clock: TopicClock | None = None


def _timed(topics: Frames, name: str, rows: DataFrame, delay: str) -> DataFrame:
    clock = getattr(topics, "clock", None)
    return clock.topic(name, rows, delay) if clock and rows.isStreaming else with_event_time(rows, delay)


def _typed(topics: Frames, name: str, schema: str, delay: str, time: str = "create_time") -> DataFrame:
    return _timed(topics, name, wide.typed(topics[name], schema, time), delay)


def _pages(topics: Frames, name: str, delay: str) -> DataFrame:
    """Page logs as written by the log job: plain JSON, not encoded."""
    raw = topics[name]
    return _timed(topics, name, logs.parse_logs(raw, encoded=False, keep=[c for c in _PLACE if c in raw.columns]), delay)


def _ties(pages: DataFrame) -> tuple[str, ...]:
    """Logs of a device with the same time go by their place in the topic, or by their text
    where a source has none, so that running a job again gives the same rows."""
    return _PLACE if set(_PLACE) <= set(pages.columns) else ("body",)


def repaired_logs(topics: Frames) -> DataFrame:
    """On a stream the flags are repaired batch by batch, see ``Job.step``."""
    rows = logs.parse_logs(topics["ODS_BASE_LOG"])
    return rows if rows.isStreaming else logs.repair_new_visitors(rows)


def split_logs(rows: DataFrame, dims: Frames) -> dict[str, DataFrame]:
    return {
        "DWD_START_LOG": logs.log_text(logs.start_logs(rows)),
        "DWD_PAGE_LOG": logs.log_text(logs.page_logs(rows)),
        "DWD_DISPLAY_LOG": logs.display_rows(rows).selectExpr("fields AS value"),
    }


def change_records(topics: Frames) -> DataFrame:
    """``seq`` orders the changes of a key over all partitions of the topic."""
    raw = topics["ODS_BASE_DB_M"]
    return changes.order_of_changes(changes.parse_changes(raw.select("value", *[c for c in _PLACE if c in raw.columns])))


def unique_visits(topics: Frames) -> DataFrame:
    """On a stream the entries, of which each batch adds those that are first."""
    raw = topics["DWD_PAGE_LOG"]
    pages = logs.parse_logs(raw, encoded=False, keep=[c for c in _PLACE if c in raw.columns])
    return visits.session_entries(pages) if raw.isStreaming else visits.unique_visits(pages, _ties(pages))


def repair_batch(rows: DataFrame, folder: str, batch_id: int) -> DataFrame:
    return FirstDays(rows.sparkSession, f"{folder}/first_days").repair(rows, batch_id)


def first_of_batch(rows: DataFrame, folder: str, batch_id: int) -> DataFrame:
    return DailyVisits(rows.sparkSession, f"{folder}/daily_visits").first(rows, batch_id, _ties(rows))


def user_jumps(topics: Frames) -> DataFrame:
    pages = _pages(topics, "DWD_PAGE_LOG", watermarks.ORDERED)
    return visits.user_jumps(pages, ties=_ties(pages))


def wide_orders(topics: Frames) -> DataFrame:
    orders = _typed(topics, "DWD_ORDER_INFO", schemas.ORDER_INFO, watermarks.ORDERED)
    return wide.order_wide(orders, _typed(topics, "DWD_ORDER_DETAIL", schemas.ORDER_DETAIL, watermarks.ORDERED))


def named_orders(rows: DataFrame, dims: Frames) -> dict[str, DataFrame]:
    named = wide.add_dimensions(rows, dims)
    return {"DWM_ORDER_WIDE": to_messages(named.select(*schemas.column_names(schemas.ORDER_WIDE)))}


def wide_payments(topics: Frames) -> DataFrame:
    payments = _typed(topics, "DWD_PAYMENT_INFO", schemas.PAYMENT_INFO, watermarks.PAYMENT, "callback_time")
    rows = wide.payment_wide(payments, _typed(topics, "DWM_ORDER_WIDE", schemas.ORDER_WIDE, watermarks.PAYMENT))
    return rows.select(*schemas.column_names(schemas.PAYMENT_WIDE))


def visitor_stats(topics: Frames) -> DataFrame:
    read = ("DWD_PAGE_LOG", "DWM_UNIQUE_VISIT", "DWM_USER_JUMP_DETAIL")
    return traffic.visitor_stats(traffic.visitor_facts(*[_pages(topics, t, watermarks.VISITOR) for t in read]))


def product_counts(topics: Frames) -> DataFrame:
    """Each topic has its own watermark, so that one topic ahead of the others makes none of
    their rows late."""

    def typed(topic: str, schema: str, time: str = "create_time") -> DataFrame:
        return _typed(topics, topic, schema, watermarks.ORDERED, time)

    facts = order_stats.product_facts(
        pages=_pages(topics, "DWD_PAGE_LOG", watermarks.ORDERED),
        orders=typed("DWM_ORDER_WIDE", schemas.ORDER_WIDE),
        payments=typed("DWM_PAYMENT_WIDE", schemas.PAYMENT_WIDE, "payment_create_time"),
        carts=typed("DWD_CART_INFO", schemas.CART),
        favors=typed("DWD_FAVOR_INFO", schemas.FAVOR),
        refunds=typed("DWD_ORDER_REFUND_INFO", schemas.REFUND),
        comments=typed("DWD_COMMENT_INFO", schemas.COMMENT),
    )
    return order_stats.product_counts(facts)


def named_products(rows: DataFrame, dims: Frames) -> dict[str, DataFrame]:
    """To the table, and to the topic that the keyword job reads."""
    named = order_stats.name_products(rows, dims)
    return {"product_stats": named, "DWS_PRODUCT_STATS": to_messages(named)}


def _order_wide(topics: Frames) -> DataFrame:
    return _typed(topics, "DWM_ORDER_WIDE", schemas.ORDER_WIDE, watermarks.ORDERED)


def province_counts(topics: Frames) -> DataFrame:
    return order_stats.province_counts(_order_wide(topics))


def province_stats_sql(topics: Frames) -> DataFrame:
    return order_stats.province_stats_sql(_order_wide(topics))


def keywords_searched(topics: Frames) -> DataFrame:
    terms = keywords.search_terms(_pages(topics, "DWD_PAGE_LOG", watermarks.SEARCH))
    return keywords.keyword_stats(keywords.split_keywords(terms, "fullword"))


def keywords_of_products(topics: Frames) -> DataFrame:
    return keywords.product_keywords(wide.typed(topics["DWS_PRODUCT_STATS"], schemas.PRODUCT_STATS_FEED, None))


def _table(name: str) -> Callable[[DataFrame, Frames], dict[str, DataFrame]]:
    return lambda rows, dims: {name: rows}


@dataclass(frozen=True)
class Job:
    reads: tuple[str, ...]
    core: Callable[[Frames], DataFrame]
    outputs: Callable[[DataFrame, Frames], dict[str, DataFrame]]
    dims: tuple[str, ...] = ()
    # what is done to each batch of a stream before the outputs, with tables in a folder
    step: Callable[[DataFrame, str, int], DataFrame] | None = None

    def run(self, topics: Frames, dims: Frames | None = None) -> dict[str, DataFrame]:
        """Both parts in one, for static frames."""
        return self.outputs(self.core(topics), dims or {})


# The names of topics and tables, here and in the functions above.
_PRODUCT_DIMS = ("sku", "spu", "category3", "trademark")

JOBS: dict[str, Job] = {
    "log_split": Job(("ODS_BASE_LOG",), repaired_logs, split_logs, step=repair_batch),
    "unique_visit": Job(
        ("DWD_PAGE_LOG",), unique_visits, lambda rows, dims: {"DWM_UNIQUE_VISIT": logs.log_text(rows)}, step=first_of_batch
    ),
    "user_jump": Job(
        ("DWD_PAGE_LOG",), user_jumps, lambda rows, dims: {"DWM_USER_JUMP_DETAIL": logs.log_text(rows)}
    ),
    "order_wide": Job(
        ("DWD_ORDER_INFO", "DWD_ORDER_DETAIL"), wide_orders, named_orders, ("user", "province", *_PRODUCT_DIMS)
    ),
    "payment_wide": Job(
        ("DWD_PAYMENT_INFO", "DWM_ORDER_WIDE"),
        wide_payments,
        lambda rows, dims: {"DWM_PAYMENT_WIDE": to_messages(rows)},
    ),
    "visitor_stats": Job(
        ("DWD_PAGE_LOG", "DWM_UNIQUE_VISIT", "DWM_USER_JUMP_DETAIL"), visitor_stats, _table("visitor_stats")
    ),
    "product_stats": Job(
        (
            "DWD_PAGE_LOG",
            "DWM_ORDER_WIDE",
            "DWM_PAYMENT_WIDE",
            "DWD_CART_INFO",
            "DWD_FAVOR_INFO",
            "DWD_ORDER_REFUND_INFO",
            "DWD_COMMENT_INFO",
        ),
        product_counts,
        named_products,
        _PRODUCT_DIMS,
    ),
    "province_stats": Job(
        ("DWM_ORDER_WIDE",),
        province_counts,
        lambda rows, dims: {"province_stats": order_stats.name_provinces(rows, dims["province"])},
        ("province",),
    ),
    "province_stats_sql": Job(("DWM_ORDER_WIDE",), province_stats_sql, _table("province_stats")),
    "keyword_search": Job(("DWD_PAGE_LOG",), keywords_searched, _table("keyword_stats")),
    "keyword_product": Job(("DWS_PRODUCT_STATS",), keywords_of_products, _table("keyword_stats")),
}

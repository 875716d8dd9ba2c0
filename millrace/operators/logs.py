"""Device logs: parsing, new-visitor repair, split into start, page and display rows.

A parsed log is flat: ``mid, vc, ch, ar, is_new, page_id, last_page_id, item,
during_time, start, display, ts, event_time, body``. ``ts`` is epoch milliseconds and
``body`` the decoded text, kept so that fields unknown to the schema survive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.functions.once import once


def parse_logs(raw: DataFrame, value: str = "value", encoded: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Decode and parse log text; rows that are not a JSON object are dropped.

    Columns of ``raw`` named in ``keep``, such as its partition and offset, stay.
    """
    text = F.try_url_decode(F.col(value).cast("string")) if encoded else F.col(value).cast("string")
    log = F.from_json("body", schemas.RAW_LOG, {"columnNameOfCorruptRecord": "_corrupt"})
    return (
        raw.select(once(text).alias("body"), *keep)
        .where("body IS NOT NULL")
        .select("body", once(log).alias("log"), *keep)
        .where("log IS NOT NULL AND log._corrupt IS NULL")
        .select(
            "log.common.*",
            "log.page.page_id",
            "log.page.last_page_id",
            "log.page.item",
            F.col("log.page.during_time").try_cast("bigint").alias("during_time"),
            "log.start",
            "log.display",
            F.col("log.ts").try_cast("bigint").alias("ts"),
            times.millis_to_time(F.col("log.ts").try_cast("bigint")).alias("event_time"),
            "body",
            *keep,
        )
    )


def repair_new_visitors(logs: DataFrame) -> DataFrame:
    """Set ``is_new`` to 0 where the device first claimed to be new on another date.

    The first date per device is a plain minimum, so it is pre-aggregated before the
    shuffle and joined back: unlike a window per device, a device that holds a large
    part of all rows is never sorted in one task. The input is read twice: where parsing is
    costly, write the parsed logs to a table first. The batches of a stream are repaired by
    ``streaming.first_seen.FirstDays``.
    """
    if logs.isStreaming:
        raise ValueError("a stream has no end to look for the first date in: repair its batches with streaming.first_seen")
    first = (
        logs.where("is_new = '1'")
        .groupBy("mid")
        .agg(F.to_date(times.millis_to_time(F.min("ts"))).alias("_first_day"))
    )
    return with_repaired_flag(logs, first)


def with_repaired_flag(logs: DataFrame, first: DataFrame) -> DataFrame:
    """The flag set to 0 where it stands on another date than ``_first_day`` of the device."""
    day = F.to_date(times.millis_to_time(F.col("ts")))
    returning = (F.col("is_new") == "1") & (day != F.col("_first_day"))
    return (
        logs.join(first, "mid", "left")
        .withColumn("is_new", F.when(returning, F.lit("0")).otherwise(F.col("is_new")))
        .select(*logs.columns)
    )


def is_start() -> Column:
    return F.coalesce(F.size("start") > 0, F.lit(False))


def start_logs(logs: DataFrame) -> DataFrame:
    return logs.where(is_start())


def page_logs(logs: DataFrame) -> DataFrame:
    return logs.where(~is_start())


def display_rows(logs: DataFrame) -> DataFrame:
    """One row per displayed item of a page log, with the page it was shown on.

    ``fields`` is the item as JSON text with all that the device sent about it, of whatever
    type and by name, and the page as ``page_id``.
    """
    # only logs with displays are read again, once, for what the schema does not name
    listed = F.try_variant_get(F.try_parse_json("body"), "$.display", "array<variant>")
    page = F.concat(F.lit('"page_id":'), F.coalesce(F.to_json(F.col("page_id").cast("variant")), F.lit("null")), F.lit("}"))
    # the members in order, the closing brace cut off; an item's own page_id goes
    sent = F.from_json("text", "map<string, variant>")
    others = F.to_json(F.map_filter(sent, lambda name, _: name != "page_id"))
    own = F.when(F.contains("text", F.lit('"page_id"')), others).otherwise(F.col("text"))
    members = F.regexp_replace(own, r"\}$", "")
    fields = F.concat(members, F.when(F.length(members) > 1, ",").otherwise(""), page)

    def field(name: str) -> Column:
        return F.try_variant_get("one", f"$.{name}", "string").alias(name)

    return (
        page_logs(logs)
        .where(F.size("display") > 0)
        .select("mid", "page_id", "ts", F.explode(listed).alias("one"))
        .select("mid", "page_id", field("item"), field("item_type"), "ts", once(F.to_json("one")).alias("text"))
        .where("text LIKE '{%'")
        .select("mid", "page_id", "item", "item_type", "ts", fields.alias("fields"))
    )


# What JSON text is made of, each character in one token.
_TOKEN = r'''("(?:[^"\\\\]|\\\\.)*+"|[{}\\[\\],:]|\\s+|[^\\s"{}\\[\\],:]+)'''


def _member_places(tokens: str, outer: str, inner: str, values: Sequence[str]) -> str:
    """Places among the tokens of the values of a member directly inside a top-level object.

    One pass with a few values as state: how deep, whether inside the object, whether a value
    comes next, and its name. Names may be written with escapes.
    """
    state = ("depth", "inside", "value", "name", "at", "found")

    def to(**changed: str) -> str:
        return "named_struct(" + ", ".join(f"'{f}', {changed.get(f, f's.{f}')}" for f in state) + ")"

    def named(name: str) -> str:
        return f"IF(contains(s.name, '\\\\'), from_json(concat('[', s.name, ']'), 'array<string>')[0], substring(s.name, 2, length(s.name) - 2)) = '{name}'"

    at = "s.at + 1"
    wanted = f"s.inside AND s.depth = 2 AND t IN ({', '.join(repr(v) for v in values)}) AND {named(inner)}"
    found = f"IF({wanted}, array_append(s.found, s.at), s.found)"
    step = f"""CASE
        WHEN t = '{{' THEN {to(at=at, depth="s.depth + 1", value="false", inside=f"IF(s.depth = 1 AND s.value, {named(outer)}, s.inside)")}
        WHEN t = '[' THEN {to(at=at, depth="s.depth + 1", value="true")}
        WHEN t IN ('}}', ']') THEN {to(at=at, depth="s.depth - 1", value="false", inside="s.inside AND s.depth > 2")}
        WHEN t = ':' THEN {to(at=at, value="true")}
        WHEN t = ',' THEN {to(at=at, value="false")}
        WHEN trim(t) = '' OR t RLIKE '^\\\\s' THEN {to(at=at)}
        WHEN s.value THEN {to(at=at, value="false", found=found)}
        ELSE {to(at=at, name="t")} END"""
    start = "named_struct('depth', 0, 'inside', false, 'value', false, 'name', '\"\"', 'at', 0, 'found', CAST(array() AS array<int>))"
    return f"aggregate({tokens}, {start}, (s, t) -> {step}, s -> s.found)"


def log_text(logs: DataFrame) -> DataFrame:
    """Log text for the next layer: the original text with the repaired flag put in.

    The flag is the member ``is_new`` directly inside the top-level object ``common``, wherever
    it stands and whatever else is there, at any depth. All other text stays as it is.
    """
    # the flag only ever changes from 1 to 0
    changed = (F.col("is_new") == "0") & F.col("body").rlike(r''':\s*("1"|1)\s*[,}]''')
    tokens = F.expr(f"regexp_extract_all(body, '{_TOKEN}', 1)")
    places = _member_places("tokens", "common", "is_new", ('"1"', "1"))
    replaced = F.expr(f"array_join(transform(tokens, (t, i) -> IF(array_contains(places, i), '\"0\"', t)), '')")
    return (
        logs.select("body", F.explode(F.array(F.when(changed, tokens))).alias("tokens"))
        .select("body", "tokens", F.explode(F.array(F.when(F.col("tokens").isNotNull(), F.expr(places)))).alias("places"))
        .select(F.when(F.size("places") > 0, replaced).otherwise(F.col("body")).alias("value"))
    )

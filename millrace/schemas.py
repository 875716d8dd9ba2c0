"""Schemas of the logs, change records, business facts and dimensions, as DDL text."""

from __future__ import annotations

# Log text as sent by devices. Scalars are read as text and cast afterwards, so a
# number sent as a string is accepted, and a number where text is expected too.
RAW_LOG = """
    common struct<mid: string, vc: string, ch: string, ar: string, is_new: string>,
    page struct<page_id: string, last_page_id: string, item: string, during_time: string>,
    start map<string, string>,
    display array<struct<item: string, item_type: string>>,
    ts string,
    _corrupt string
"""

# With the time of the record, its transaction and the position in that.
CHANGE_RECORD = "table string, type string, data map<string, string>, ts string, xid string, xoffset string"

ROUTING = """
    source_table string, operate_type string, sink_type string, sink_table string,
    sink_columns string, sink_pk string, sink_extend string
"""

ORDER_INFO = """
    id bigint, province_id bigint, order_status string, user_id bigint,
    total_amount decimal(18,2), activity_reduce_amount decimal(18,2),
    coupon_reduce_amount decimal(18,2), original_total_amount decimal(18,2),
    feight_fee decimal(18,2), expire_time string, create_time string,
    operate_time string, create_date string, create_hour string
"""

ORDER_DETAIL = """
    id bigint, order_id bigint, sku_id bigint, order_price decimal(18,2),
    sku_num bigint, sku_name string, create_time string,
    split_total_amount decimal(18,2), split_activity_amount decimal(18,2),
    split_coupon_amount decimal(18,2)
"""

PAYMENT_INFO = """
    id bigint, order_id bigint, user_id bigint, total_amount decimal(18,2),
    subject string, payment_type string, create_time string, callback_time string
"""

ORDER_WIDE = """
    detail_id bigint, order_id bigint, sku_id bigint, order_price decimal(18,2),
    sku_num bigint, sku_name string, province_id bigint, order_status string,
    user_id bigint, total_amount decimal(18,2), activity_reduce_amount decimal(18,2),
    coupon_reduce_amount decimal(18,2), original_total_amount decimal(18,2),
    feight_fee decimal(18,2), split_feight_fee decimal(18,2),
    split_activity_amount decimal(18,2), split_coupon_amount decimal(18,2),
    split_total_amount decimal(18,2), expire_time string, create_time string,
    operate_time string, create_date string, create_hour string,
    province_name string, province_area_code string, province_iso_code string,
    province_3166_2_code string, user_age int, user_gender string, spu_id bigint,
    tm_id bigint, category3_id bigint, spu_name string, tm_name string,
    category3_name string
"""

PAYMENT_WIDE = """
    payment_id bigint, subject string, payment_type string, payment_create_time string,
    callback_time string, detail_id bigint, order_id bigint, sku_id bigint,
    order_price decimal(18,2), sku_num bigint, sku_name string, province_id bigint,
    order_status string, user_id bigint, total_amount decimal(18,2),
    activity_reduce_amount decimal(18,2), coupon_reduce_amount decimal(18,2),
    original_total_amount decimal(18,2), feight_fee decimal(18,2),
    split_feight_fee decimal(18,2), split_activity_amount decimal(18,2),
    split_coupon_amount decimal(18,2), split_total_amount decimal(18,2),
    order_create_time string, province_name string, province_area_code string,
    province_iso_code string, province_3166_2_code string, user_age int,
    user_gender string, spu_id bigint, tm_id bigint, category3_id bigint,
    spu_name string, tm_name string, category3_name string
"""

CART = "sku_id bigint, create_time string"
FAVOR = CART
REFUND = "sku_id bigint, order_id bigint, refund_amount decimal(18,2), create_time string"
COMMENT = "sku_id bigint, appraise string, create_time string"

PRODUCT_STATS_FEED = """
    spu_name string, click_ct bigint, cart_ct bigint, order_ct bigint, stt string, edt string
"""

# Codes carried by the business tables.
APPRAISE_GOOD = "1201"
KEYWORD_SEARCH, KEYWORD_CLICK, KEYWORD_CART, KEYWORD_ORDER = "SEARCH", "CLICK", "CART", "ORDER"


def column_names(ddl: str) -> list[str]:
    """Names of the top-level columns of one of the flat schemas above."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fieldNames()

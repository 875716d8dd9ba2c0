"""The queries of ``queries.py`` as plain SQL over the same tables."""

from __future__ import annotations

# Common table expressions, each with those it needs.
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": (
        (),
        """
        SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts,
               CAST(json_extract_string(props, '$.k') AS INT) AS k
        FROM events
        """,
    ),
    "pages_log": (
        ("ev",),
        """
        SELECT event_id, CAST(user_id AS VARCHAR) AS mid, CAST(k % 3 AS VARCHAR) AS vc,
               event_type AS ch, CAST(c_nationkey AS VARCHAR) AS ar,
               CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'good_list'
                    WHEN 'signup' THEN 'home' WHEN 'purchase' THEN 'trade' ELSE 'mine' END AS page_id,
               CASE WHEN k % 2 = 1 THEN 'home' END AS last_page_id,
               CAST(k AS VARCHAR) AS item, CAST(floor(value) AS BIGINT) AS during_time,
               event_type, k, ts, make_timestamp_ms(ts) AS event_time
        FROM ev LEFT JOIN customer ON c_custkey = user_id
        """,
    ),
    "uniques": (
        ("pages_log",),
        """
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY mid, CAST(event_time AS DATE) ORDER BY ts, event_id) AS nth
          FROM pages_log WHERE last_page_id IS NULL) WHERE nth = 1
        """,
    ),
    "ordered": (
        ("pages_log",),
        """
        SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) - ts AS gap FROM pages_log
        """,
    ),
    "jumps": (
        ("ordered",),
        "SELECT * FROM ordered WHERE last_page_id IS NULL AND (gap IS NULL OR gap >= 10000)",
    ),
    "visitor_rows": (
        ("pages_log", "uniques", "jumps"),
        """
        SELECT ts, event_time, vc, ch, ar, is_new, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum FROM uniques
        UNION ALL SELECT ts, event_time, vc, ch, ar, is_new, 0, 1, 0, 0, during_time FROM pages_log
        UNION ALL SELECT ts, event_time, vc, ch, ar, is_new, 0, 0, 1, 0, 0 FROM pages_log WHERE last_page_id IS NULL
        UNION ALL SELECT ts, event_time, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM jumps
        """,
    ),
    "change_rows": (
        ("ev",),
        """
        SELECT event_id AS seq, CASE WHEN k % 10 <> 6 THEN event_type END AS "table",
               CASE k % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete' ELSE 'bootstrap-insert' END AS "type",
               CASE k % 10 WHEN 9 THEN NULL WHEN 8 THEN 2 WHEN 7 THEN 0 ELSE 4 END AS fields,
               CAST(event_id AS VARCHAR) AS data_event_id, CAST(user_id AS VARCHAR) AS data_user_id,
               CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS data_value, CAST(ts AS VARCHAR) AS data_ts
        FROM ev
        """,
    ),
    "routes": (
        (),
        """
        SELECT * FROM (VALUES
          ('click', 'insert', 'kafka', 'dwd_click', 'event_id,user_id,value', 'id'),
          ('click', 'update', 'kafka', 'dwd_click', '', 'id'),
          ('view', 'insert', 'kafka', 'dwd_view', NULL, 'id'),
          ('signup', 'insert', 'hbase', 'dim_signup', 'user_id,value,ts', 'user_id'),
          ('signup', 'update', 'hbase', 'dim_signup', 'user_id,value', 'user_id'),
          ('signup', 'delete', 'hbase', 'dim_signup', 'user_id,value,ts', 'user_id'),
          ('purchase', 'insert', 'hbase', 'dim_purchase', 'event_id,user_id', 'event_id')
        ) AS r(source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk)
        """,
    ),
    "routed": (
        ("change_rows", "routes"),
        """
        SELECT seq, "table", replace("type", 'bootstrap-', '') AS "type", sink_type, sink_table, sink_pk,
               CASE WHEN wanted IS NULL OR list_contains(wanted, 'event_id') THEN data_event_id END AS data_event_id,
               CASE WHEN wanted IS NULL OR list_contains(wanted, 'user_id') THEN data_user_id END AS data_user_id,
               CASE WHEN wanted IS NULL OR list_contains(wanted, 'value') THEN data_value END AS data_value,
               CASE WHEN wanted IS NULL OR list_contains(wanted, 'ts') THEN data_ts END AS data_ts
        FROM change_rows
        JOIN (SELECT *, CASE WHEN sink_columns <> '' THEN string_split(sink_columns, ',') END AS wanted FROM routes)
          ON source_table = "table" AND operate_type = replace("type", 'bootstrap-', '')
        WHERE fields >= 3
        """,
    ),
    "order_rows": (
        (),
        """
        SELECT o_orderkey AS id, c_nationkey AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, o_orderdate AS event_time
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
        """,
    ),
    "wide": (
        ("order_rows",),
        """
        SELECT l_orderkey * 10 + l_linenumber AS detail_id, o.id AS order_id, l_partkey AS sku_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
               'sku ' || l_partkey AS sku_name, CAST(province_id AS BIGINT) AS province_id, order_status, user_id,
               total_amount, CAST(l_extendedprice AS DECIMAL(18,2)) AS split_total_amount,
               strftime(o.event_time, '%Y-%m-%d %H:%M:%S') AS create_time,
               strftime(o.event_time, '%Y-%m-%d') AS create_date, strftime(o.event_time, '%H') AS create_hour,
               o.event_time AS event_time
        FROM order_rows o JOIN lineitem ON l_orderkey = o.id
          AND l_shipdate BETWEEN o.event_time - INTERVAL 30 DAY AND o.event_time + INTERVAL 30 DAY
        """,
    ),
    "payment_rows": (
        (),
        """
        SELECT l_orderkey AS id, l_orderkey AS order_id, min(l_suppkey) AS user_id, min(l_shipdate) AS event_time,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
        FROM lineitem GROUP BY l_orderkey
        """,
    ),
    "paid": (
        ("payment_rows", "wide"),
        """
        SELECT p.id AS payment_id, 'order ' || p.id AS subject, '1101' AS payment_type,
               strftime(p.event_time, '%Y-%m-%d %H:%M:%S') AS payment_create_time,
               strftime(p.event_time, '%Y-%m-%d %H:%M:%S') AS callback_time,
               w.detail_id, p.order_id, w.sku_id, p.user_id, p.total_amount, w.split_total_amount,
               w.create_time AS order_create_time, w.province_id, w.order_status, p.event_time AS event_time
        FROM payment_rows p JOIN wide w ON w.order_id = p.order_id
          AND w.event_time BETWEEN p.event_time - INTERVAL 30 DAY AND p.event_time
        """,
    ),
    "skus": (
        (),
        """
        SELECT p_partkey AS id, p_name || ' ' || p_size AS sku_name, p_partkey // 10 AS spu_id,
               CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS tm_id,
               CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS category3_id
        FROM part
        """,
    ),
    "spus": ((), "SELECT p_partkey // 10 AS id, min(p_name) AS spu_name FROM part GROUP BY 1"),
    "categories": (
        (),
        "SELECT CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS id, min(p_type) AS category3_name FROM part GROUP BY 1",
    ),
    "brands": (
        (),
        "SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS id, min(p_brand) AS tm_name FROM part GROUP BY 1",
    ),
    "provinces": (
        (),
        """
        SELECT n_nationkey AS id, n_name AS name, 'CN-' || n_nationkey AS iso_3166_2, r_name AS iso_code,
               CAST(n_regionkey AS VARCHAR) AS area_code
        FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
        """,
    ),
    "product_rows": (
        ("pages_log", "ev", "wide", "paid"),
        """
        SELECT event_time, CAST(item AS BIGINT) AS sku_id, 'click' AS kind, NULL AS order_id, 0 AS sku_num,
               CAST(0 AS DECIMAL(18,2)) AS amount, 0 AS good FROM pages_log WHERE page_id = 'good_detail'
        UNION ALL SELECT event_time, k, 'display', NULL, 0, 0, 0 FROM pages_log WHERE event_type = 'view'
        UNION ALL SELECT event_time, sku_id, 'order', order_id, sku_num, split_total_amount, 0 FROM wide
        UNION ALL SELECT make_timestamp_ms(ts), k, 'cart', NULL, 0, 0, 0 FROM ev WHERE event_type = 'click'
        UNION ALL SELECT event_time, sku_id, 'payment', order_id, 0, split_total_amount, 0 FROM paid
        UNION ALL SELECT l_shipdate, l_partkey, 'refund', l_orderkey, 0, CAST(l_extendedprice AS DECIMAL(18,2)), 0
          FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT make_timestamp_ms(ts), k, 'favor', NULL, 0, 0, 0 FROM ev WHERE event_type = 'signup'
        UNION ALL SELECT make_timestamp_ms(ts), k, 'comment', NULL, 0, 0, CASE WHEN k >= 50 THEN 1 ELSE 0 END
          FROM ev WHERE event_type = 'purchase'
        """,
    ),
    "product_totals": (
        ("product_rows",),
        """
        SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS win, sku_id,
               count(*) FILTER (kind = 'display') AS display_ct, count(*) FILTER (kind = 'click') AS click_ct,
               count(*) FILTER (kind = 'favor') AS favor_ct, count(*) FILTER (kind = 'cart') AS cart_ct,
               CAST(coalesce(sum(sku_num) FILTER (kind = 'order'), 0) AS BIGINT) AS order_sku_num,
               coalesce(sum(amount) FILTER (kind = 'order'), 0) AS order_amount,
               count(DISTINCT order_id) FILTER (kind = 'order') AS order_ct,
               coalesce(sum(amount) FILTER (kind = 'payment'), 0) AS payment_amount,
               count(DISTINCT order_id) FILTER (kind = 'payment') AS paid_order_ct,
               count(DISTINCT order_id) FILTER (kind = 'refund') AS refund_order_ct,
               coalesce(sum(amount) FILTER (kind = 'refund'), 0) AS refund_amount,
               count(*) FILTER (kind = 'comment') AS comment_ct,
               CAST(coalesce(sum(good) FILTER (kind = 'comment'), 0) AS BIGINT) AS good_comment_ct
        FROM product_rows GROUP BY 1, 2
        """,
    ),
    "product_named": (
        ("product_totals", "skus", "spus", "categories", "brands"),
        """
        SELECT strftime(win, '%Y-%m-%d %H:%M:%S') AS stt, strftime(win + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
               t.sku_id, s.sku_name, CAST(NULL AS DECIMAL(18,2)) AS sku_price, s.spu_id, spu_name, s.tm_id, tm_name,
               s.category3_id, category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount,
               order_ct, payment_amount, paid_order_ct, refund_order_ct, refund_amount, comment_ct, good_comment_ct
        FROM product_totals t LEFT JOIN skus s ON s.id = t.sku_id LEFT JOIN spus ON spus.id = s.spu_id
        LEFT JOIN categories c ON c.id = s.category3_id LEFT JOIN brands b ON b.id = s.tm_id
        """,
    ),
    "province_totals": (
        ("wide",),
        """
        SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS win, province_id,
               sum(split_total_amount) AS order_amount, count(DISTINCT order_id) AS order_count
        FROM wide GROUP BY 1, 2
        """,
    ),
    "province_named": (
        ("province_totals", "provinces"),
        """
        SELECT strftime(win, '%Y-%m-%d %H:%M:%S') AS stt, strftime(win + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
               province_id, name AS province_name, area_code, iso_code, iso_3166_2, order_amount, order_count
        FROM province_totals LEFT JOIN provinces ON id = province_id
        """,
    ),
    "searched": (
        ("pages_log",),
        "SELECT item AS fullword, ts, event_time FROM pages_log WHERE page_id = 'good_list' AND item IS NOT NULL",
    ),
    "searched_words": (
        ("searched",),
        """
        SELECT lower(unnest(regexp_extract_all(fullword, '[\\pL\\pM\\pN]+'))) AS keyword, ts, event_time FROM searched
        """,
    ),
}


def _with(names: tuple[str, ...], select: str) -> str:
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in _CTE[name][0]:
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    if not needed:
        return select
    return "WITH " + ", ".join(f"{n} AS ({_CTE[n][1]})" for n in needed) + select


_LOG = "mid, vc, ch, ar, is_new, page_id, last_page_id, item, during_time, ts"
_PAGE_ONLY = (
    "mid, vc, ch, ar, is_new, CASE WHEN ch <> 'signup' THEN page_id END AS page_id, "
    "CASE WHEN ch <> 'signup' THEN last_page_id END AS last_page_id, "
    "CASE WHEN ch <> 'signup' THEN item END AS item, "
    "CASE WHEN ch <> 'signup' THEN during_time END AS during_time, ts"
)
_REPAIRED = """
  SELECT event_id, mid, k, ts,
         CASE WHEN is_new = '1' AND CAST(event_time AS DATE) <> min(CASE WHEN is_new = '1' THEN CAST(event_time AS DATE) END)
                   OVER (PARTITION BY mid) THEN '0' ELSE is_new END AS is_new
"""
_COUNTS = """
  SELECT {cols}, click_ct AS ct, 'CLICK' AS source FROM {t} WHERE click_ct > 0
  UNION ALL SELECT {cols}, cart_ct, 'CART' FROM {t} WHERE cart_ct > 0
  UNION ALL SELECT {cols}, order_ct, 'ORDER' FROM {t} WHERE order_ct > 0
"""


def all_oracles() -> dict[str, str]:
    found = {
        "log_parse": _with(("pages_log",), f"SELECT {_PAGE_ONLY} FROM pages_log"),
        "new_visitor_repair": _with(("pages_log",), f"SELECT event_id, mid, is_new, ts FROM ({_REPAIRED} FROM pages_log)"),
        "split_start": _with(
            ("pages_log",), "SELECT mid, 'icon' AS entry, ts FROM pages_log WHERE ch = 'signup'"
        ),
        "split_page": _with(("pages_log",), f"SELECT {_LOG} FROM pages_log WHERE ch <> 'signup'"),
        "split_display": _with(
            ("pages_log",),
            """
            , shown AS (
              SELECT mid, page_id, k, 'sku_id' AS item_type, 0 AS place, ts FROM pages_log WHERE event_type = 'view'
              UNION ALL SELECT mid, page_id, k + 1, 'activity_id', 1, ts FROM pages_log WHERE event_type = 'view'
            )
            SELECT mid, page_id, CAST(k AS VARCHAR) AS item, item_type, ts,
                   '{"display_type":"query","item":"' || k || '","item_type":"' || item_type || '","order":' || place ||
                   ',"page_id":"' || page_id || '"}' AS fields
            FROM shown
            """,
        ),
        "repaired_log_text": _with(
            ("pages_log",), f"SELECT mid, is_new, ts FROM ({_REPAIRED} FROM pages_log)"
        ),
        "typed_orders": _with(
            ("order_rows",),
            """
            SELECT id, user_id, order_status, total_amount, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS create_time,
                   epoch_ms(event_time) AS ts FROM order_rows
            """,
        ),
        "typed_payments": _with(
            ("payment_rows",),
            """
            SELECT id, order_id, user_id, total_amount, 'order ' || id AS subject, '1101' AS payment_type,
                   epoch_ms(date_trunc('second', event_time)) AS ts FROM payment_rows
            """,
        ),
        "typed_wide_orders": _with(
            ("wide",),
            """
            SELECT detail_id, order_id, sku_id, split_total_amount, sku_name, province_id, create_date,
                   CAST(NULL AS INTEGER) AS user_age, epoch_ms(date_trunc('second', event_time)) AS ts FROM wide
            """,
        ),
        "approx_province_orders": _with(  # sketches of so few orders are exact
            ("wide",),
            """
            SELECT strftime(date_trunc('day', event_time), '%Y-%m-%d %H:%M:%S') AS stt,
                   strftime(date_trunc('day', event_time) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS edt,
                   province_id, count(DISTINCT order_id) AS approx_order_count
            FROM wide GROUP BY ALL
            """,
        ),
        "typed_details": """
            SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
                   CAST(l_quantity AS BIGINT) AS sku_num, CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price,
                   'sku ' || l_partkey AS sku_name, epoch_ms(l_shipdate) AS ts FROM lineitem
        """,
        "json_topic_view": _with(
            ("order_rows",),
            "SELECT strftime(event_time, '%Y-%m-%d') AS day, count(*) AS orders, sum(total_amount) AS amount FROM order_rows GROUP BY 1",
        ),
        "text_times": _with(
            ("order_rows",),
            """
            SELECT id, epoch_ms(event_time) AS time_ms, epoch_ms(event_time) AS ms,
                   epoch_ms(date_trunc('day', event_time)) AS day_ms, strftime(event_time, '%Y%m%d') AS day FROM order_rows
            """,
        ),
        "first_row_wins": """
            SELECT CAST(n_nationkey AS VARCHAR) AS ID, n_name AS NAME,
                   (SELECT arg_min(c_name, c_custkey) FROM customer WHERE c_nationkey = n_nationkey) AS first_customer
            FROM nation
        """,
        "replayed_events": _with(("ev",), "SELECT event_id, CAST(user_id AS VARCHAR) AS mid, ts FROM ev"),
        "chinese_pairs": """
            WITH t AS (SELECT p_name, translate(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), '0123456789', '零一二三四五六七八九')
                              || '零一二三四五六七八九' AS run FROM part),
            w AS (SELECT substr(run, i, 2) AS keyword FROM t, generate_series(1, 18) AS g(i)
                  UNION ALL SELECT unnest(string_split(lower(p_name), ' ')) FROM t)
            SELECT keyword, count(*) AS ct FROM w GROUP BY 1
        """,
        "chinese_dictionary": """
            WITH t AS (SELECT lower(p_name) || translate(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), '0123456789', '零一二三四五六七八九')
                              || '零一二三四五六七八九' AS text FROM part),
            w AS (SELECT unnest(regexp_extract_all(text, '零一二三四五六七八九|一二三|零零|二三|[零一二三四五六七八九]|[a-z0-9]+')) AS keyword FROM t)
            SELECT keyword, count(*) AS ct FROM w GROUP BY 1
        """,
        "chinese_lattice": """
            WITH RECURSIVE t AS (
                SELECT lower(p_name) AS name, translate(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), '0123456789', '零一二三四五六七八九')
                       || '零一二三四五六七八九' AS run FROM part
            ), words AS (
                SELECT unnest(['零一二三四五六七八九', '一二三', '零零', '二三']) AS word
            ), paths AS (  -- all ways to split a run
                SELECT DISTINCT run, 0 AS pos, 0 AS covered, [] :: INTEGER[] AS sizes FROM t
                UNION ALL
                SELECT run, pos + size, covered + CASE WHEN size > 1 THEN size ELSE 0 END, list_append(sizes, size)
                FROM (
                    SELECT p.*, o.size FROM paths p, (SELECT 1 AS size, NULL AS word UNION ALL SELECT length(word), word FROM words) o
                    WHERE p.pos < length(run) AND (o.word IS NULL OR substr(run, p.pos + 1, o.size) = o.word)
                )
            ), best AS (
                SELECT run, sizes FROM paths WHERE pos = length(run)
                QUALIFY row_number() OVER (PARTITION BY run ORDER BY covered DESC, len(sizes), sizes DESC) = 1
            ), cut AS (
                SELECT run, substr(run, CAST(coalesce(list_sum(list_slice(sizes, 1, i - 1)), 0) AS BIGINT) + 1, sizes[i]) AS keyword
                FROM (SELECT run, sizes, unnest(range(1, len(sizes) + 1)) AS i FROM best)
            ), w AS (
                SELECT keyword FROM t JOIN cut USING (run)
                UNION ALL SELECT unnest(string_split(name, ' ')) FROM t
            )
            SELECT keyword, count(*) AS ct FROM w GROUP BY 1
        """,
        "session_entries": _with(
            ("pages_log",), "SELECT event_id, mid, page_id, ts FROM pages_log WHERE last_page_id IS NULL"
        ),
        "unique_visits": _with(("uniques",), "SELECT event_id, mid, page_id, ts FROM uniques"),
        "user_jumps": _with(("jumps",), "SELECT event_id, mid, page_id, ts FROM jumps"),
        "user_jumps_30m": _with(
            ("ordered",),
            """
            SELECT event_id, mid, page_id, ts FROM ordered
            WHERE last_page_id IS NULL AND (gap IS NULL OR gap >= 1800000)
            """,
        ),
        "cdc_filter": _with(
            ("change_rows",),
            """
            SELECT seq, "table", "type", data_event_id, data_user_id, data_value, data_ts
            FROM change_rows WHERE "table" IS NOT NULL AND fields >= 3
            """,
        ),
        "cdc_normalise": _with(
            ("change_rows",), """SELECT seq, "table", replace("type", 'bootstrap-', '') AS "type" FROM change_rows"""
        ),
        "cdc_route": _with(("routed",), 'SELECT seq, "table", "type", sink_type, sink_table, sink_pk FROM routed'),
        "cdc_project_columns": _with(
            ("routed",), "SELECT seq, sink_table, data_event_id, data_user_id, data_value, data_ts FROM routed"
        ),
        "route_fact_topics": _with(
            ("routed",),
            """
            SELECT upper(sink_table) AS topic, data_event_id AS event_id, data_user_id AS user_id,
                   data_value AS value, data_ts AS ts
            FROM routed WHERE sink_type = 'kafka'
            """,
        ),
        "dim_upsert_latest": _with(
            ("routed",),
            """
            , mine AS (
              SELECT *, coalesce(max(CASE WHEN "type" = 'delete' THEN seq END) OVER (PARTITION BY data_user_id), -1) AS gone
              FROM routed WHERE sink_table = 'dim_signup'
            )
            SELECT data_user_id AS user_id, arg_max(data_value, seq) AS value,
                   arg_max(data_ts, seq) FILTER ("type" = 'insert') AS ts, CAST(NULL AS VARCHAR) AS event_id
            FROM mine WHERE seq > gone GROUP BY data_user_id
            UNION ALL SELECT arg_max(data_user_id, seq), NULL, NULL, data_event_id
            FROM routed WHERE sink_table = 'dim_purchase' GROUP BY data_event_id
            """,
        ),
        "order_wide_interval": _with(
            ("wide",),
            """
            SELECT detail_id, order_id, sku_id, order_price, sku_num, sku_name, province_id, order_status, user_id,
                   total_amount, split_total_amount, create_time, create_date, create_hour FROM wide
            """,
        ),
        "payment_wide_interval": _with(
            ("paid",),
            """
            SELECT payment_id, subject, payment_type, payment_create_time, callback_time, detail_id, order_id, sku_id,
                   user_id, total_amount, split_total_amount, order_create_time, province_id, order_status FROM paid
            """,
        ),
        "order_wide_dims": _with(
            ("wide", "skus", "spus", "categories", "brands", "provinces"),
            """
            SELECT detail_id, order_id, w.sku_id, coalesce(s.sku_name, w.sku_name) AS sku_name, split_total_amount,
                   CAST(floor((DATE '2024-02-01' - (DATE '1960-01-01' + CAST(c_custkey % 15000 AS INT))) / 365.0) AS INT) AS user_age,
                   CASE WHEN c_custkey % 2 = 0 THEN 'M' WHEN c_custkey % 2 = 1 THEN 'F' END AS user_gender,
                   p.name AS province_name, p.area_code AS province_area_code, p.iso_code AS province_iso_code,
                   p.iso_3166_2 AS province_3166_2_code, s.spu_id, s.tm_id, s.category3_id, spu_name, tm_name, category3_name
            FROM wide w LEFT JOIN customer ON c_custkey = w.user_id LEFT JOIN provinces p ON p.id = w.province_id
            LEFT JOIN skus s ON s.id = w.sku_id LEFT JOIN spus ON spus.id = s.spu_id
            LEFT JOIN categories c ON c.id = s.category3_id LEFT JOIN brands b ON b.id = s.tm_id
            """,
        ),
        "wide_coalesce": _with(
            ("order_rows",),
            """
            , ours AS (
              SELECT id AS order_id, nullif(order_status, 'P') AS order_status, user_id,
                     CASE WHEN total_amount >= 100000 THEN total_amount END AS total_amount FROM order_rows
            ), lines AS (
              SELECT l_orderkey AS order_id, max('sku ' || l_partkey) AS order_status,
                     sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_amount,
                     CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sku_num
              FROM lineitem GROUP BY 1
            )
            SELECT coalesce(a.order_id, b.order_id) AS order_id, coalesce(a.order_status, b.order_status) AS order_status,
                   a.user_id, CAST(coalesce(a.total_amount, b.total_amount) AS DECIMAL(38,2)) AS total_amount, b.sku_num
            FROM ours a FULL JOIN lines b ON a.order_id = b.order_id
            """,
        ),
        "user_age": """
            SELECT CAST(c_custkey AS VARCHAR) AS "ID",
                   CAST(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INT) AS VARCHAR) AS "BIRTHDAY",
                   CAST(floor((DATE '2024-02-01' - (DATE '1960-01-01' + CAST(c_custkey % 15000 AS INT))) / 365.0) AS INT) AS age
            FROM customer
        """,
        "visitor_fact_union": _with(
            ("visitor_rows",),
            """
            SELECT ts, vc, ch, ar, is_new, CAST(uv_ct AS BIGINT) AS uv_ct, CAST(pv_ct AS BIGINT) AS pv_ct,
                   CAST(sv_ct AS BIGINT) AS sv_ct, CAST(uj_ct AS BIGINT) AS uj_ct, CAST(dur_sum AS BIGINT) AS dur_sum
            FROM visitor_rows
            """,
        ),
        "visitor_stats": _with(("visitor_rows",), _VISITOR_STATS),
        "product_facts": _with(
            ("product_rows",),
            """
            SELECT epoch_ms(event_time) AS ts, sku_id, kind, CAST(order_id AS BIGINT) AS order_id,
                   CAST(sku_num AS BIGINT) AS sku_num, amount, CAST(good AS BIGINT) AS good FROM product_rows
            """,
        ),
        "product_stats": _with(("product_named",), "SELECT * FROM product_named"),
        "province_stats": _with(("province_named",), "SELECT * FROM province_named"),
        "province_stats_sql": _with(("province_named",), "SELECT * FROM province_named"),
        "sink_projection": _with(("province_named",), "SELECT * FROM province_named"),
        "search_terms": _with(("searched",), "SELECT fullword, ts FROM searched"),
        "search_keywords": _with(("searched_words",), "SELECT keyword, ts FROM searched_words"),
        "keyword_stats_search": _with(("searched_words",), _KEYWORD_STATS),
        "counts_to_rows": _with(
            ("product_totals",),
            ", totals AS (SELECT *, strftime(win, '%Y-%m-%d %H:%M:%S') AS stt FROM product_totals)"
            + _COUNTS.format(cols="sku_id, stt", t="totals"),
        ),
        "product_keywords": _with(
            ("product_named",),
            f"""
            , counted AS ({_COUNTS.format(cols="spu_name, stt, edt", t="product_named")})
            SELECT lower(unnest(regexp_extract_all(spu_name, '[\\pL\\pM\\pN]+'))) AS keyword, ct, source, stt, edt FROM counted
            """,
        ),
        "document_keywords": """
            SELECT lang, keyword, count(*) AS ct
            FROM (SELECT lang, lower(unnest(regexp_extract_all(text, '[\\pL\\pM\\pN]+'))) AS keyword FROM documents)
            GROUP BY lang, keyword
        """,
    }
    # the same changes by another road
    return {**found, "dim_upsert_ordered": found["dim_upsert_latest"]}


_VISITOR_STATS = """
  SELECT strftime(time_bucket(INTERVAL 10 SECOND, event_time), '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
         vc, ch, ar, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
         CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
         CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
  FROM visitor_rows GROUP BY 1, 2, 3, 4, 5, 6
"""

_KEYWORD_STATS = """
  SELECT keyword, count(*) AS ct, 'SEARCH' AS source,
         strftime(time_bucket(INTERVAL 10 SECOND, event_time), '%Y-%m-%d %H:%M:%S') AS stt,
         strftime(time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt
  FROM searched_words GROUP BY 1, 4, 5
"""


def stream_oracles() -> dict[str, str]:
    """For the streaming forms: the same rows as in the batch forms."""
    batch = all_oracles()
    same = ("new_visitor_repair", "unique_visits", "user_jumps", "visitor_stats", "product_stats", "province_stats")
    return {
        **{f"stream_{name}": batch[name] for name in (*same, "province_stats_sql")},
        "stream_daily_visits": batch["unique_visits"],
        "stream_admission": _with(
            ("pages_log",),
            """
            , parted AS (
                SELECT event_id, ts, CAST(item AS INTEGER) % 10 AS digit,
                       CAST((ts - min(ts) OVER ()) * 3 // (max(ts) OVER () - min(ts) OVER () + 1) AS INTEGER) AS part FROM pages_log
            ), newest AS (  -- of what was sent before the last part
                SELECT max(ts) - 11 * 86400000 AS late FROM parted WHERE digit <> 3 AND part < 2
            )
            SELECT event_id, CASE WHEN digit = 3 AND ts < late THEN 'late' ELSE 'on_time' END AS admission FROM parted, newest
            UNION ALL SELECT event_id, 'repeated' FROM parted WHERE digit = 7
            """,
        ),
        "stream_visitor_stats_by_part": batch["visitor_stats"],
        "stream_keyword_stats": batch["keyword_stats_search"],
        "stream_order_wide": _with(
            ("wide",), "SELECT detail_id, order_id, sku_id, split_total_amount, create_time FROM wide"
        ),
        "stream_payment_wide": _with(
            ("paid",), "SELECT payment_id, detail_id, user_id, total_amount, callback_time FROM paid"
        ),
    }

"""Statistics tables: their columns, and writers for a store reached over JDBC.

The columns are spelled out per table. Working columns of an operator are never part of
them, and ``ts`` (when the row was computed) is added here where the operator has none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from millrace.functions import times

VISITOR_TABLE = """
    stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct bigint,
    pv_ct bigint, sv_ct bigint, uj_ct bigint, dur_sum bigint, ts bigint
"""

PRODUCT_TABLE = """
    stt string, edt string, sku_id bigint, sku_name string, sku_price decimal(18,2),
    spu_id bigint, spu_name string, tm_id bigint, tm_name string, category3_id bigint,
    category3_name string, display_ct bigint, click_ct bigint, favor_ct bigint,
    cart_ct bigint, order_sku_num bigint, order_amount decimal(38,2), order_ct bigint,
    payment_amount decimal(38,2), paid_order_ct bigint, refund_order_ct bigint,
    refund_amount decimal(38,2), comment_ct bigint, good_comment_ct bigint, ts bigint
"""

PROVINCE_TABLE = """
    stt string, edt string, province_id bigint, province_name string, area_code string,
    iso_code string, iso_3166_2 string, order_amount decimal(38,2), order_count bigint,
    ts bigint
"""

KEYWORD_TABLE = "keyword string, ct bigint, source string, stt string, edt string, ts bigint"

TABLES: Mapping[str, str] = {
    "visitor_stats": VISITOR_TABLE,
    "product_stats": PRODUCT_TABLE,
    "province_stats": PROVINCE_TABLE,
    "keyword_stats": KEYWORD_TABLE,
}

DEFAULT_JDBC_BATCH = 10_000


def conform(rows: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a table, in its order and types; anything else is left out."""
    fields = StructType.fromDDL(ddl)
    if "ts" in fields.fieldNames() and "ts" not in rows.columns:
        rows = rows.withColumn("ts", times.now_millis())
    return rows.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields])


def jdbc_writer(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = DEFAULT_JDBC_BATCH,
    connections: int = 16,
    into: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that inserts into a table, ``into`` if it has another name there.

    ``connections`` bounds how many tasks write at the same time. A batch that is run
    again after a failure is inserted again: the store must replace rows by key, or the
    function be wrapped in ``sinks.ledger.inserted_once``.
    """
    options = {**(properties or {}), "batchsize": str(batch_size)}

    def write(batch: DataFrame, batch_id: int) -> None:
        conform(batch, TABLES[table]).coalesce(connections).write.jdbc(url, into or table, mode="append", properties=options)

    return write


def folder_writer(path: str, job: str, table: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch of a job to its own folder.

    A batch that is run again replaces its folder, so the table holds each row once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = conform(batch, TABLES[table]) if table else batch
        rows.write.mode("overwrite").parquet(f"{path}/job={job}/batch={batch_id}")

    return write

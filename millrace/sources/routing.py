"""The table that says where the changes of a source table go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas

# One row per source table and operation: a control table, not data.
MAX_ROUTES = 100_000


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """A configuration or dimension table over JDBC."""
    return spark.read.jdbc(url, table, properties=properties or {})


def load_routing(table: DataFrame) -> DataFrame:
    """Check the routing table and hold it as a local relation, so its size is known.

    An empty table, or one with two rows for the same key, is an error. It is the one
    table read through the driver, and only up to ``MAX_ROUTES``.
    """
    columns = schemas.column_names(schemas.ROUTING)
    rows = table.select(*columns).limit(MAX_ROUTES + 1).collect()
    if not rows:
        raise ValueError("the routing table is empty")
    if len(rows) > MAX_ROUTES:
        raise ValueError(f"the routing table has more than {MAX_ROUTES} rows")
    keys = [(r["source_table"], r["operate_type"]) for r in rows]
    if len(set(keys)) < len(keys):
        raise ValueError("the routing table has two rows for the same table and operation")
    return table.sparkSession.createDataFrame(rows, schemas.ROUTING)


def dimension_routes(routing: DataFrame) -> list[dict[str, str]]:
    """Dimension tables named in a loaded routing table: table, columns and key.

    Whatever the operation, a route to a table makes it: the table has the columns of all its
    routes, those of the insert first, whose key and clause count where it has them. A
    table for which no route names a column is an error.
    """
    rows = (
        routing.where(F.lower("sink_type") == "hbase")
        .select(F.upper("sink_table").alias("table"), "operate_type", "sink_columns", "sink_pk", "sink_extend")
        .collect()
    )
    tables: dict[str, dict[str, str]] = {}
    for r in sorted(rows, key=lambda r: (r["operate_type"] != "insert", r["operate_type"] or "")):
        known = tables.setdefault(r["table"], {"sink_columns": "", "sink_pk": "", "sink_extend": ""})
        names = [*known["sink_columns"].split(","), *(c.strip() for c in (r["sink_columns"] or "").split(","))]
        known["sink_columns"] = ",".join(dict.fromkeys(n for n in names if n))
        for c in ("sink_pk", "sink_extend"):
            known[c] = known[c] or r[c] or ""
    bare = sorted(name for name, r in tables.items() if not r["sink_columns"])
    if bare:
        raise ValueError(f"no route names the columns of {', '.join(bare)}")
    return [
        {
            "table": name,
            "columns": r["sink_columns"],
            "key": r["sink_pk"] or "id",
            "extend": r["sink_extend"] or "",
        }
        for name, r in sorted(tables.items())
    ]

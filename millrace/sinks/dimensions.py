"""Dimension tables kept from change records."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructType

from millrace.operators.changes import apply_changes, dimension_schema
from millrace.sinks.keyed import BUCKET, BUCKETS, BucketedTable, bucket_of

# When each column of a row was last set.
SET_AT = "_set_at"
# Tables that one batch changes at the same time.
TABLES_AT_ONCE = 8


def create_table_sql(table: str, sink_columns: str, sink_pk: str | None = None, extend: str | None = None) -> str:
    """DDL of a dimension table: text columns, key not null, and a free clause at the end."""
    fields = dimension_schema(sink_columns, sink_pk)
    listed = ", ".join(f"`{f.name}` STRING{'' if f.nullable else ' NOT NULL'}" for f in fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({listed}) USING parquet {extend or ''}".strip()


def buckets_named(extend: str | None) -> int:
    """The number of buckets that the extra clause of a table asks for: ``SALT_BUCKETS = 16``
    or ``INTO 16 BUCKETS``; without one the default."""
    found = re.search(r"BUCKETS\s*=\s*(\d+)|INTO\s+(\d+)\s+BUCKETS", extend or "", re.I)
    return max(1, int(found[1] or found[2])) if found else BUCKETS


class DimensionTables:
    """Dimension tables in one folder, each split into buckets by a hash of its key.

    A batch reads and writes only the buckets of the keys that it changes. For every column
    of a row it is kept which change set it, so a change that comes in a later batch than a
    newer one changes nothing, and running a batch again gives the same table. Versions do
    not depend on batch numbers, which may start anew. A deleted key is forgotten: an older
    change that comes in a later batch makes its row again. The extra clause of a table
    gives its number of buckets, for good, and is kept with it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def store(self, table: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/{table}")

    def read(self, table: str, schema: StructType, spark: SparkSession | None = None) -> DataFrame:
        """The newest version; empty when there is none."""
        return self.store(table).read(schema, spark=spark)

    def ensure(self, table: str, columns: Sequence[str], key: str, extend: str | None = None) -> dict:
        """Create a table without rows where there is none, so that it can be joined."""
        store = self.store(table)
        store.buckets = buckets_named(extend)
        return store.create(columns=list(columns), key=key, extend=extend or "")

    def latest(self, table: str) -> DataFrame:
        """The newest version of a table that exists."""
        manifest = self.store(table).manifest()
        return self.read(table, dimension_schema(",".join(manifest["columns"]), manifest["key"]))

    def merge(
        self,
        table: str,
        columns: Sequence[str],
        key: str,
        changes: DataFrame,
        deletes: bool = True,
        extend: str | None = None,
        touched: Sequence[int] | None = None,
    ) -> list[int]:
        """Apply the changes of a batch, in order of ``seq``; returns the buckets written.

        ``seq`` is a number, or a struct whose fields are compared one after another.
        """
        number = self.ensure(table, columns, key, extend)["number_of_buckets"]
        store = self.store(table)
        mine = changes.select("type", "data", "seq").where(F.col("data")[key].isNotNull())
        if touched is None:
            # at most one row per bucket
            found = mine.select(bucket_of(F.col("data")[key], number).alias("b")).distinct().collect()
            touched = sorted(r["b"] for r in found)
        if not touched:
            return []
        order = changes.schema["seq"].dataType
        merged = apply_changes(
            self._as_changes(store, columns, key, order, touched, changes.sparkSession).unionByName(mine, allowMissingColumns=True),
            key, columns, "seq", deletes, SET_AT,
        )
        store.replace(merged.withColumn(BUCKET, bucket_of(F.col(key), number)), touched, columns=list(columns), key=key)
        return list(touched)

    def _as_changes(
        self, store: BucketedTable, columns: Sequence[str], key: str, order: DataType, touched: Sequence[int], spark: SparkSession
    ) -> DataFrame:
        """The rows of some buckets as inserts with the times that set their columns."""
        schema = dimension_schema(",".join(columns), key).add(SET_AT, MapType(StringType(), order))
        current = store.read(schema, touched, spark)
        pairs = [x for c in columns for x in (F.lit(c), F.col(c))]
        set_at = F.col(SET_AT)
        data = F.map_filter(F.create_map(*pairs), lambda name, _: (name == key) | F.map_contains_key(set_at, name))
        return current.select(
            F.lit("insert").alias("type"), data.alias("data"), F.array_max(F.map_values(set_at)).alias("seq"), SET_AT
        )

    def merge_all(self, routes: Sequence[Mapping[str, str]], changes: DataFrame, deletes: bool = True) -> dict[str, list[int]]:
        """Apply a batch with changes to many tables, from rows that also have ``sink_table``.

        One pass finds what is touched; tables without changes are left alone, the others
        are merged side by side.
        """
        by_table = {r["table"]: r for r in routes}
        number = {}
        for name, r in by_table.items():
            number[name] = self.ensure(name, r["columns"].split(","), r["key"], r.get("extend"))["number_of_buckets"]
        if not by_table:
            return {}

        def of_table(values: Mapping[str, str | int]):
            return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("sink_table")]

        key = F.col("data")[of_table({name: r["key"] for name, r in by_table.items()})]
        hit = changes.where(F.col("sink_table").isin(*by_table)).select("sink_table", key.alias("key")).where("key IS NOT NULL")
        # at most one row per table and bucket
        hit = hit.select("sink_table", bucket_of(F.col("key"), of_table(number)).alias("b")).distinct().collect()
        touched = {name: sorted(r["b"] for r in hit if r["sink_table"] == name) for name in {r["sink_table"] for r in hit}}

        def one(name: str) -> list[int]:
            r = by_table[name]
            mine = changes.where(F.col("sink_table") == name)
            return self.merge(name, r["columns"].split(","), r["key"], mine, deletes, r.get("extend"), touched[name])

        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            return dict(zip(touched, pool.map(one, touched)))

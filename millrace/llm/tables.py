"""Reading the sample tables, written intermediate tables, and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of at most this many rows of at most 64 bytes is sent to every executor.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of its own in local mode where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=8)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def settle(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read them from there.

    Cuts the lineage: a lost executor costs no recomputation of what came before.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """A name for a column of our own that none of these columns has."""
    taken, out = {c.lower() for c in columns}, f"_{name}"
    while out.lower() in taken:
        out += "_"
    return out


def narrow_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast of a side with a few numbers in each of its counted rows.

    Beyond the limit it is left to a shuffle join, whose hot partitions adaptive execution
    splits.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")

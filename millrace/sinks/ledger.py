"""Inserts that a batch run again does not repeat, for stores that do not replace rows by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from millrace.sinks.keyed import SmallFiles

Writer = Callable[[DataFrame, int], None]


class Ledger:
    """The batches of a job that are in the store: an empty file for each."""

    def __init__(self, spark, path: str):
        self.files = SmallFiles(spark, path)

    def has(self, batch_id: int) -> bool:
        return self.files.exists(f"done/{batch_id:012d}")

    def add(self, batch_id: int) -> None:
        self.files.write(f"done/{batch_id:012d}", b"")


def inserted_once(insert: Writer, path: str, job: str) -> Writer:
    """A ``foreachBatch`` function that inserts each batch of a job once.

    A batch is first written to a staging folder of its job and number. What is staged
    whole is inserted, then entered in the ledger; a batch in the ledger is passed over.
    A batch that failed before its insert was finished is inserted from what is staged,
    not computed again, so it is the same rows. The store must take a batch as a whole or not at all;
    one moment is left open, between the store's commit and the entry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ledger = Ledger(batch.sparkSession, f"{path}/job={job}")
        if ledger.has(batch_id):
            return
        staged = f"{path}/job={job}/staged/batch={batch_id}"
        if not ledger.files.exists(f"staged/batch={batch_id}/_SUCCESS"):
            batch.write.mode("overwrite").parquet(staged)
        insert(batch.sparkSession.read.schema(batch.schema).parquet(staged), batch_id)
        ledger.add(batch_id)
        ledger.files.delete(f"staged/batch={batch_id}")

    return write

"""A corpus in five stages: language, near duplicates, benchmark, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.llm import bpe, decontaminate, language, near_dups, secrets  # noqa: E402
from millrace.llm.tables import narrow_broadcast, settle, table  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure and whose text is like it; others go.

    Null and empty texts, and those without three letters in a row, go, as they show no
    language. Repeated rows are each judged.
    """
    return language.identify_languages(docs).where("language.accepted").drop("language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows equal in id and text, one.

    Rows that repeat an id with another text are judged by their own text each. Rows with a
    null id, and null and empty texts, are near duplicates of nothing and stay.
    """
    groups = settle(near_dups.near_duplicates(docs, with_node=True))
    gone = groups.where("NOT kept").select("doc_id", "node").distinct()
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = settle(repeated)
    alone = gone.join(narrow_broadcast(repeated, repeated.count()), "doc_id", "left_anti").select("doc_id")
    once = docs.join(narrow_broadcast(alone, alone.count()), "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return once
    # only the rows of repeated ids need their node, the hash of their set, again
    several = once.join(narrow_broadcast(repeated, repeated.count()), "doc_id", "left_semi")
    several = several.select(*docs.columns).withColumn("node", near_dups.node_of("text"))
    several = several.join(gone, ["doc_id", "node"], "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    others = once.join(narrow_broadcast(repeated, repeated.count()), "doc_id", "left_anti").select(*docs.columns)
    return others.unionByName(several)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item.

    A document goes by its id, and all rows of that id with it; rows with a null id stay. Null
    and empty texts hold no item and stay.
    """
    found = settle(decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))
    gone = found.select("doc_id").distinct()
    return docs.join(narrow_broadcast(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and their lengths counted anew. Null texts stay null."""
    clean = secrets.redact(secrets.scan_secrets(docs)).select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of its tokens and the digests of its ids and decoded text. A null text
    is an empty one."""
    return bpe.digests(docs, bpe.default_vocabulary())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

# Edit distance within a text and merges by rank are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs

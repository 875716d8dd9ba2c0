"""Exact length histogram: what every context limit keeps of a corpus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import fresh, settle

# Lengths next to each other that one task sums up.
BLOCK = 256


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``n_tokens``, the encoded length of the whole text.

    ``ranks_path`` names a file of byte-pair ranks, read on the driver; ``pattern`` cuts texts
    into words. A null text has no tokens. Strings of special tokens are ordinary text.
    """
    with open(ranks_path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))
    kept = [c for c in docs.columns if c not in (text, "n_tokens")]
    name = fresh(docs.columns, "text")
    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(*shipped.value)
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t.as_py() or "")) for t in batch[name]]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(counts, pa.int64())], [*kept, "n_tokens"])

    return given.mapInArrow(run, given.drop(name).schema.add("n_tokens", "long"))


_ENCODINGS: dict[int, object] = {}


def _encoding(ranks: bytes, pattern: str):
    """One encoder per worker process."""
    import base64

    import tiktoken

    key = hash((ranks, pattern))
    if key not in _ENCODINGS:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _ENCODINGS[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[key]


def length_histogram(lengths: DataFrame, n_tokens: str = "n_tokens") -> DataFrame:
    """A row per encoded length that occurs, with what a context limit of that length keeps.

    ``context_limit`` is the length. ``n_docs`` documents have it, ``docs_within`` are no
    longer and ``docs_over`` are longer; ``tokens_within`` is the total of the former;
    ``truncated_total`` is the total of all documents cut at the limit, ``total`` that of all
    documents whole, and ``quantile`` the share of documents within. Any limit between two
    rows is answered from the row below it: its truncated total is
    ``tokens_within + docs_over * limit``.

    Documents are counted per length before anything is sorted; the counts are written once
    and read by what follows, so each text is encoded once. Sums over lengths are taken
    in blocks of ``BLOCK`` lengths, with the sums over whole blocks carried in, so no task
    holds all lengths. Null lengths count for nothing; no documents, no rows.
    """
    counts = lengths.where(F.col(n_tokens).isNotNull()).groupBy(F.col(n_tokens).cast("long").alias("context_limit")).agg(F.count(F.lit(1)).alias("n_docs"))
    counts = settle(counts).withColumn("_block", F.floor(F.col("context_limit") / BLOCK))
    tokens = F.col("n_docs") * F.col("context_limit")
    blocks = counts.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum(tokens).alias("_tokens"))
    # one row per block of lengths: as many as the longest text has blocks
    onward = Window.orderBy("_block")
    before = onward.rowsBetween(Window.unboundedPreceding, -1)
    whole = onward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = blocks.select(
        "_block",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_docs", "_tokens")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("_docs", "_tokens")],
    )
    here = Window.partitionBy("_block").orderBy("context_limit").rowsBetween(Window.unboundedPreceding, 0)
    within = counts.join(carried, "_block").select(
        "context_limit",
        "n_docs",
        (F.col("_docs_before") + F.sum("n_docs").over(here)).alias("docs_within"),
        (F.col("_tokens_before") + F.sum(tokens).over(here)).alias("tokens_within"),
        "_docs_all",
        F.col("_tokens_all").alias("total"),
    )
    over = F.col("_docs_all") - F.col("docs_within")
    return within.select(
        "context_limit",
        "n_docs",
        "docs_within",
        over.alias("docs_over"),
        "tokens_within",
        (F.col("tokens_within") + over * F.col("context_limit")).alias("truncated_total"),
        "total",
        (F.col("docs_within") / F.col("_docs_all")).alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, truncated_total, docs_over`` for a few given limits, from the histogram."""
    sums = []
    for limit in limits:
        kept = F.least(F.col("context_limit"), F.lit(limit)) * F.col("n_docs")
        sums += [
            F.coalesce(F.sum(kept), F.lit(0)).alias(f"t{limit}"),
            F.coalesce(F.sum(F.when(F.col("context_limit") > limit, F.col("n_docs"))), F.lit(0)).alias(f"d{limit}"),
        ]
    rows = [F.struct(F.lit(x).cast("long").alias("context_limit"), F.col(f"t{x}").alias("truncated_total"), F.col(f"d{x}").alias("docs_over")) for x in limits]
    return histogram.agg(*sums).select(F.inline(F.array(*rows)))


def quantile_lengths(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, context_limit``: the smallest limit that holds this share of the documents whole."""
    found = [F.min(F.when(F.col("quantile") >= share, F.col("context_limit"))).alias(f"s{i}") for i, share in enumerate(shares)]
    rows = [F.struct(F.lit(float(share)).alias("share"), F.col(f"s{i}").alias("context_limit")) for i, share in enumerate(shares)]
    return histogram.agg(*found).select(F.inline(F.array(*rows)))

"""Ranked lexical search: impact vectors in buckets of like length, pruned, then scored exactly."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import settle

# Items are searched for in blocks of so many letters, each with a pass over the documents.
BLOCK_LETTERS = 2_000_000
# Documents of a bucket: neighbours in the order of length.
BUCKET = 4096
# About so many of the longest vectors are scored first, for a first bound of every item.
HEAD = 4096
# A text is cut into words in slices of so many bytes.
SLICE = 1 << 22

# Bytes of a term are 0-9, a-z and all outside ASCII; A-Z become a-z, all others a space.
_TERMS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_VECTOR = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
_FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, slice by slice; a slice ends between two terms."""
    spaced = (text or b"").translate(_TERMS)
    at = 0
    while at < len(spaced):
        end = len(spaced) if len(spaced) - at <= SLICE else spaced.rfind(b" ", at, at + SLICE)
        end = end if end > at else (spaced.find(b" ", at + 1) if spaced.find(b" ", at + 1) > 0 else len(spaced))
        yield spaced[at:end].split()
        at = end


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item: str = "text",
    block_letters: int = BLOCK_LETTERS,
    bucket: int = BUCKET,
    head: int = HEAD,
) -> DataFrame:
    """A row ``item_id, rank, doc_id, score`` for each of an item's ``k`` best documents.

    Terms are runs of 0-9, A-Z, a-z and characters outside ASCII, A-Z lower-cased. With N
    documents that hold a term, L terms in all, n terms of a document, df documents that
    hold a term and tf its count in a document, the weight of a term is
    ``floor(1000 * ln((2N + 2) / (2df + 1)))``, its impact
    ``10**9 * tf div (1000 * tf + 8 * (10 + 90 * n * N div L))``, and a score the sum of
    weight times impact over the different terms of the item.

    A document is the vector of its impacts on terms of the items. Vectors are sorted by
    length over the cluster and read in buckets of neighbours. An item skips a bucket where
    its own length times that of the bucket's longest vector (Cauchy and Schwarz) stays
    below the item's ``k``-th best score so far. Inside, the heaviest of its terms are
    summed up until the rest of the item could not reach that score alone; only documents
    with one of these terms remain, and of them those whose sum, with the rest bounded by
    the lengths of what is left of both vectors, reaches it. They are scored in integers.
    Bounds begin with those of about ``head`` longest vectors; every task raises its own.
    Bounds only spare work: the result is that of scoring every document.

    Equal scores rank by ascending id, null ids last. Null and empty texts and those without
    a term match nothing and do not count; null and empty items have no rows. Repeated rows
    count and rank each; equal items are ranked each. Empty tables give no rows. Other columns are not looked at.
    Items come to the driver and the tasks in blocks of ``block_letters`` letters, a pass of
    the documents each.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item).cast("binary").alias("item")).where("octet_length(item) > 0")
    asked = settle(asked.withColumn("item", F.col("item")).withColumn("at", F.monotonically_increasing_id()))
    letters = asked.agg(F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()[0]
    blocks = max(1, -(-letters // block_letters))
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("at"), F.lit(blocks)) == block)
        rows = [(r["at"], sorted({t for part in terms_of(bytes(r["item"])) for t in part})) for r in mine.select("at", "item").collect()]
        here = _search(given, [(at, terms) for at, terms in rows if terms], k, bucket, head)
        found = here if found is None else found.unionByName(here)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # one row for each item, and k for each of them in the result
    return ranked.join(asked.select("at", "item_id"), F.col("item") == F.col("at")).select("item_id", "rank", "doc_id", "score")


def _search(given: DataFrame, items: list[tuple[int, list[bytes]]], k: int, bucket: int, head: int) -> DataFrame:
    spark = given.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    known = spark.sparkContext.broadcast(vocabulary)
    vectors = settle(given.mapInArrow(_vectors(known), _VECTOR))
    documents, words = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one number for each term of this block's items
    holders = np.zeros(len(vocabulary), dtype=np.int64)
    counted = vectors.select("terms").mapInArrow(_holders(len(vocabulary)), "term int, n bigint")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        holders[row["term"]] = row["n"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in holders.tolist()], dtype=np.int64)
    # only documents that hold a term of the items, longest first; equal ones over several ranges
    impacts = vectors.where(F.size("terms") > 0).mapInArrow(
        _impacts(documents, words), "doc_id bigint, norm double, terms array<int>, impacts array<int>"
    )
    impacts = settle(impacts.withColumn("salt", F.monotonically_increasing_id()))
    order = [F.col("norm").desc(), F.col("doc_id"), F.col("salt")]
    index = settle(impacts.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt"))
    queries = _Queries([(at, np.array([vocabulary[t] for t in terms], dtype=np.int64)) for at, terms in items], weights)
    # the longest vectors give each item a first bound
    share = min(1.0, head / max(1, documents))
    cut = index.agg(F.percentile_approx("norm", 1 - share, 10_000)).first()[0] or 0.0
    first = index.where(F.col("norm") >= cut).mapInArrow(_searcher(spark.sparkContext.broadcast(queries), k, bucket), _FOUND)
    place = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    # of each item only its k-th best score is sent
    kth = first.withColumn("rank", F.row_number().over(place)).where(F.col("rank") == k)
    queries = queries.with_bounds({r["item"]: r["score"] for r in kth.select("item", "score").collect()})
    # vectors shorter than this are of no use to any item, and their row groups not read
    least = queries.least_norm()
    shipped = spark.sparkContext.broadcast(queries)
    return index.where(F.col("norm") >= least).mapInArrow(_searcher(shipped, k, bucket), _FOUND)


def _vectors(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            ids, sizes, ends, terms, counts = [], [], [0], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: Counter = Counter()
                n = 0
                for part in terms_of(text.as_py()):
                    n += len(part)
                    held.update(map(get, part))
                if not n:
                    continue
                held.pop(None, None)
                ids.append(doc)
                sizes.append(n)
                terms.extend(held.keys())
                counts.extend(held.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return run


def _holders(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["term", "n"])

    return run


def _impacts(documents: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, terms, counts = batch.columns
            lengths = np.diff(terms.offsets.to_numpy())
            m = 10 + (90 * n.to_numpy() * documents) // words
            tf = counts.flatten().to_numpy().astype(np.int64)
            impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, lengths))
            norms = np.sqrt(_sums(impacts.astype(np.float64) ** 2, lengths))
            held = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(impacts, pa.int32())
            )
            yield pa.RecordBatch.from_arrays([ids, pa.array(norms), terms, held], ["doc_id", "norm", "terms", "impacts"])

    return run


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces of these lengths."""
    return np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=values, minlength=len(lengths))


class _Queries:
    """Items as vectors of weights, heaviest term first, each with a score that it has ``k`` times at least."""

    def __init__(self, items: list[tuple[int, np.ndarray]], weights: np.ndarray, bounds: dict[int, int] | None = None):
        self.weights = weights
        self.items = [(at, terms[np.argsort(-weights[terms], kind="stable")]) for at, terms in items]
        squares = [weights[terms].astype(np.float64) ** 2 for _, terms in self.items]
        # the length of what is left of an item after its first terms
        self.rest = [np.sqrt(np.append(np.cumsum(s[::-1])[::-1], 0.0)) for s in squares]
        self.bounds = [max(1, (bounds or {}).get(at, 1)) for at, _ in self.items]

    def with_bounds(self, bounds: dict[int, int]) -> "_Queries":
        return _Queries(self.items, self.weights, bounds)

    def least_norm(self) -> float:
        return min((low * (1 - 1e-9) / rest[0] for low, rest in zip(self.bounds, self.rest) if rest[0] > 0), default=0.0)


class _Best:
    """The k best of an item in this task, and the score that further ones must reach."""

    def __init__(self, k: int, bound: int):
        self.k, self.bound = k, bound
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)
        self.nulls = np.zeros(0, dtype=bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, nulls = np.concatenate([self.ids, ids]), np.concatenate([self.nulls, nulls])
        best = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]
        if len(best) == self.k:
            self.bound = max(self.bound, int(self.scores[-1]))


def _searcher(shipped, k: int, bucket: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shipped.value
        best = [_Best(k, low) for low in queries.bounds]
        for batch in batches:
            for at in range(0, batch.num_rows, bucket):
                _search_bucket(batch.slice(at, bucket), queries, best)
        for start in range(0, len(best), 1000):
            part = [(at, b) for (at, _), b in zip(queries.items[start : start + 1000], best[start : start + 1000])]
            scores = np.concatenate([np.zeros(0, dtype=np.int64), *(b.scores for _, b in part)])
            ids = np.concatenate([np.zeros(0, dtype=np.int64), *(b.ids for _, b in part)])
            nulls = np.concatenate([np.zeros(0, dtype=bool), *(b.nulls for _, b in part)])
            owner = np.repeat(np.array([at for at, _ in part], dtype=np.int64), [len(b.scores) for _, b in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(ids, mask=nulls), pa.array(scores)], ["item", "doc_id", "score"]
            )

    return run


def _search_bucket(batch: pa.RecordBatch, queries: _Queries, best: list[_Best]) -> None:
    ids, norms, terms, impacts = batch.columns
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    norms = norms.to_numpy()
    size, longest = len(ids), norms.max(initial=0.0)
    lengths = np.diff(terms.offsets.to_numpy())
    held = terms.flatten().to_numpy()
    # postings of the bucket: the documents of each term, and their impacts
    order = np.argsort(held, kind="stable")
    docs = np.repeat(np.arange(size), lengths)[order]
    values = impacts.flatten().to_numpy().astype(np.int64)[order]
    ends = np.searchsorted(held[order], np.arange(len(queries.weights) + 1))
    squares = norms * norms
    for (_, wanted), rest, top in zip(queries.items, queries.rest, best):
        low = top.bound * (1 - 1e-9)
        if rest[0] * longest < low:
            continue
        # the shortest beginning of the item without which nothing reaches the bound
        focus = int(np.argmax(rest * longest < low)) if rest[-1] * longest < low else len(wanted)
        parts = [slice(ends[t], ends[t + 1]) for t in wanted]
        sums = np.zeros(size, dtype=np.int64)
        left = squares.copy()
        for t, part in zip(wanted[:focus], parts):
            # a document holds a term once, so no place is met twice
            sums[docs[part]] += queries.weights[t] * values[part]
            left[docs[part]] -= values[part].astype(np.float64) ** 2
        reach = sums + rest[focus] * np.sqrt(np.maximum(left, 0.0) + 1e-3 * squares**0.5)
        near = np.flatnonzero((sums > 0) & (reach >= low))
        if not len(near):
            continue
        for t, part in zip(wanted[focus:], parts[focus:]):
            sums[docs[part]] += queries.weights[t] * values[part]
        near = near[sums[near] >= top.bound]
        if len(near):
            top.add(sums[near], ids[near], nulls[near])

"""Near-duplicate documents: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.sketching import band_keys, set_hash, shingle_set, sketch
from millrace.llm.tables import narrow_broadcast, settle

WIDTH = 5
PERCENT = 75
# A pair at the least similarity shares no band with a chance of (1 - 0.75^5)^50 = 1.3e-6.
BANDS = 50
ROWS = 5
# Sizes of this many parts of two sets bound what they can have in common.
PARTS = 16
STAR_ROUNDS = 1

_PROFILE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
_SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("items", T.ArrayType(T.LongType()))])


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    with_node: bool = False,
) -> DataFrame:
    """Groups of documents whose sets of word shingles are alike.

    Two documents are linked where 100 * intersection >= ``percent`` * union of their sets.
    Returns a row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``,
    and ``node``, the hash of the row's set, ``with_node``.

    Documents with the same set are one node. The nodes are sketched, the bands of a sketch
    are buckets, and only nodes of one bucket are compared, on their full sets. A bucket is
    never paired out: its members are compared with one of them first, later ones only
    with members outside their own component (see ``_links``), which finds the same
    components.

    A null or empty text, or one without words, has no shingles and is linked with nothing.
    A row with a null id counts for nobody, has a null component and is kept. Rows that
    repeat an id are looked at by their own text each. Other columns are not looked at.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    profile = settle(given.mapInArrow(_profiler(width, bands, rows), _PROFILE))
    # a node's bands are those of its set: whichever copy they come from
    nodes = profile.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("of")
    )
    in_bands = nodes.select("node", "of.doc_id", F.col("of.n_shingles").alias("n"), F.explode("of.bands").alias("key"))
    crowded = in_bands.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("here")).where("here > 1")
    shared = settle(in_bands.join(crowded.select("key", "center"), "key"))
    labels = _labels(shared, given, width, percent)

    members = profile.select("doc_id", "n_shingles", "node")
    found = members.join(narrow_broadcast(labels, labels.count()), "node", "left").select(
        "doc_id", "n_shingles", "node", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "node")).alias("label")
    )
    found = settle(found)
    first = found.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size"))
    first = settle(first.where("size > 1").select("label", "first"))
    return (
        found.join(narrow_broadcast(first, first.count()), "label", "left")
        .withColumn("component_id", F.coalesce("first", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept", *["node"] * with_node)
    )


def node_of(text: str, width: int = WIDTH) -> Column:
    """The hash of the set of a text, as in ``node``."""

    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        return pd.Series([set_hash(shingle_set(t, width)) for t in texts], dtype="int64")

    return node(F.col(text))


def _labels(shared: DataFrame, given: DataFrame, width: int, percent: int) -> DataFrame:
    """Component of every node with a link, from the members ``key, node, doc_id, n, center`` of buckets."""
    wanted = settle(shared.select("doc_id", "node").distinct())
    sets = _sets(given, wanted, width)
    # the same center in as many buckets as can be: most pairs come up again and again
    pairs = shared.select("node", "n", F.col("center").alias("other_node")).where("node <> other_node")
    edges = settle(_linked(pairs, sets, percent))
    labels = components(edges)
    for turn in range(STAR_ROUNDS + 1):
        known = shared.select("key", "node", "n").join(narrow_broadcast(labels, labels.count()), "node", "left")
        known = known.select("key", "node", "n", F.coalesce("label", "node").alias("label"))
        opened = _without_hopeless(_of_several_labels(settle(known)), sets, percent)
        # another center every time, drawn by chance
        lot = F.xxhash64("key", "node", F.lit(turn))
        of_head = {c: f"other_{c}" for c in opened.columns if c != "key"}
        head = F.max(F.struct(lot.alias("lot"), *[F.col(c).alias(d) for c, d in of_head.items()]))
        heads = opened.groupBy("key").agg(head.alias("head"), F.count(F.lit(1)).alias("here"))
        outside = settle(opened.join(heads.select("key", "head.*", "here"), "key").where("label <> other_label"))
        to_do = outside.agg(F.sum("here").alias("all"), F.count(F.lit(1)).alias("star")).first()
        if not to_do["star"]:
            break
        last = turn == STAR_ROUNDS or to_do["all"] <= 4 * to_do["star"]
        if last:
            # every pair of different components that has not met: those outside the component
            # of the head with everybody
            outside = outside.select(*opened.columns)
            outside = outside.join(opened.select("key", *[F.col(c).alias(d) for c, d in of_head.items()]), "key")
        pairs = outside.where((F.col("label") != F.col("other_label")) & _may_be_alike(percent, last))
        edges = edges.unionByName(settle(_linked(pairs, sets, percent)))
        labels = components(edges)
        if last:
            break
    return labels


def _of_several_labels(known: DataFrame) -> DataFrame:
    """The rows of buckets whose members are in more than one component."""
    spread = known.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return known.join(spread.where("low <> high").select("key"), "key")


def _without_hopeless(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows with the sizes of the ``PARTS`` parts of their sets.

    Shingles that no other node here has are left out: they are in the union with any other
    node and never in the intersection, so a node with too many of them is like none and
    goes. The rest is parted by hash; an intersection is no larger than the sum over the
    parts of the smaller size. Edited copies of one text and texts that share a passage
    are told apart by this without their full sets.
    """
    opened = settle(opened)
    # at most one key per band
    nodes = opened.groupBy("node").agg(F.collect_set("key").alias("keys"))
    parts = range(PARTS)
    items = sets.join(nodes.select("node"), "node").select("node", F.explode("items").alias("item"))
    alone = items.groupBy("item").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("in")).where("in = 1")

    def per_part(rows: DataFrame, name: str) -> DataFrame:
        part = F.pmod("item", F.lit(PARTS))
        return rows.groupBy("node").agg(*[F.count(F.when(part == i, 1)).cast("int").alias(f"{name}{i}") for i in parts])

    # what a node has in common with others, part by part
    common = per_part(items, "part").join(per_part(alone, "own"), "node", "left").select(
        "node", *[(F.col(f"part{i}") - F.coalesce(f"own{i}", F.lit(0))).alias(f"part{i}") for i in parts]
    )
    counted = opened.join(common.join(nodes, "node"), "node")
    left = sum((F.col(f"part{i}") for i in parts), F.lit(0))
    return settle(_of_several_labels(settle(counted.where(100 * left >= percent * F.col("n")))))


def _may_be_alike(percent: int, once: bool) -> Column:
    """Whether the sizes of the parts leave two nodes enough in common."""
    most = sum((F.least(f"part{i}", f"other_part{i}") for i in range(PARTS)), F.lit(0))
    enough = 100 * most >= percent * (F.col("n") + F.col("other_n") - most)
    # of the buckets that two nodes share, one brings them together
    return enough if not once else enough & (F.col("key") == F.array_min(F.array_intersect("keys", "other_keys")))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``node, other_node`` whose full sets are alike, as ``a, b``."""
    once = pairs.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()
    first = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    second = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    sized = once.join(first, "a").join(second, "b").where(_sizes_fit(F.size("items_a"), F.size("items_b"), percent))
    both = F.size(F.array_intersect("items_a", "items_b"))
    return sized.where(100 * both >= percent * (F.size("items_a") + F.size("items_b") - both)).select("a", "b")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _sets(given: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, items``: the full set of every wanted node, made again from its text.

    Few texts are wanted; keeping the sets of all would take twice the room of the input.
    """
    of_wanted = given.join(narrow_broadcast(wanted, wanted.count()), "doc_id").select("node", "text")
    sets = settle(of_wanted.mapInArrow(_set_maker(width), _SETS))
    # a row that is there twice makes its set twice
    return sets if sets.count() == sets.select("node").distinct().count() else settle(sets.dropDuplicates(["node"]))


def _profiler(width: int, bands: int, rows: int):
    """Per row its id, the size and hash of its set, and the keys of its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text, width) for text in part["text"].to_pylist()]
                keys = [band_keys(sketch(s, bands * rows), bands, rows) if len(s) else np.empty(0, np.int64) for s in sets]
                columns = [
                    part["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) for s in sets], pa.int64()),
                    _lists(keys),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "bands"])

    return run


def _set_maker(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(text, width) for text in part["text"].to_pylist()]
                here = [(node, s) for node, s in zip(part["node"].to_pylist(), sets) if node == set_hash(s)]
                nodes = pa.array([node for node, _ in here], pa.int64())
                yield pa.RecordBatch.from_arrays([nodes, _lists([s for _, s in here])], ["node", "items"])

    return run


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([v.view(np.int64) for v in values]) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

"""Approximate nearest neighbours: a neighbour graph by NN-descent, greedy graph search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import settle

# Neighbours kept per vector.
DEGREE = 32
# Of those that have a vector as a neighbour so many are introduced to its own neighbours in a round.
SAMPLE = 20
# Introductions that one host offers a guest, and hosts that one group of rows holds.
OFFERS = 6
HOSTS = 128
# Vectors of one leaf of a random projection tree, which start as each other's neighbours.
LEAF = 256
# The descent ends when a round changes less than this share of the graph.
LEAST_CHANGE = 0.05
# Candidates that a search keeps.
BEAM = 200
# Parts that the copies of one vector are numbered in before they are numbered together.
SALTS = 16


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    degree: int = DEGREE,
    beam: int = BEAM,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row where ``queries`` holds.

    ``score`` is the Euclidean distance of the vectors as given, in double precision; ranks
    go by it, ties to the smaller id. A query is no candidate of its own.

    Every different vector is a node of the graph, its copies being one node with the
    smallest id of them, so any number of copies costs no more edges than one. A search
    starts at the neighbours of the query's own node and goes on with the neighbours of the
    nearest ones, until a step finds nothing nearer. Graph and search use vectors of one
    byte a component; what they find is measured on the vectors as given and ranked by that.

    Vectors that are null, zero, or hold a null or a value that is not finite take no part,
    neither do rows with a null id nor vectors of another length than most (of equally
    frequent lengths, the smallest counts); of rows that repeat an id, the smallest vector
    counts. With fewer candidates than ``k`` all that are found are returned. Other columns
    are not looked at.
    """
    given = settle(_points(vectors, vec_id, embedding, queries))
    lengths = given.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    given = given.where(F.size("v") == (lengths["n"] if lengths else 0))
    members = settle(_members(given, k + 1))
    nodes = members.where("id = node").select("id", "v", _code("v").alias("code"))
    nodes = settle(nodes)
    asked = settle(given.where("asked").select(F.col("id").alias("query_id"), "v").join(nodes.select("v", F.col("id").alias("from")), "v").select("query_id", "from"))
    starts = asked.select("from").distinct().join(nodes.select(F.col("id").alias("from"), "code", "v"), "from")
    starts = settle(starts)
    found = search(nodes, build_graph(nodes, degree), starts, 3 * k, beam)

    # measured exactly; a copy beyond the first of its node comes after the node in any ranking
    order = Window.partitionBy("from").orderBy("d", "node")
    exactly = found.join(nodes.select(F.col("id").alias("node"), F.col("v").alias("w")), "node").join(starts.select("from", "v"), "from")
    exactly = exactly.select("from", "node", _distance(F.col("v"), F.col("w")).alias("d"))
    near = exactly.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select("from", "node", "d")
    near = near.unionByName(starts.select("from", F.col("from").alias("node"), F.lit(0.0).alias("d")))
    order = Window.partitionBy("from").orderBy("d", "vec_id")
    near = near.join(members.select("node", F.col("id").alias("vec_id")), "node")
    near = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).select("from", "vec_id", "d")
    order = Window.partitionBy("query_id").orderBy("d", "vec_id")
    ranked = asked.join(near, "from").where("query_id <> vec_id").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score"))


def _points(vectors: DataFrame, vec_id: str, embedding: str, queries: Column) -> DataFrame:
    given = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")
    )
    usable = (
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    return given.where(F.coalesce(usable, F.lit(False))).groupBy("id").agg(F.min("v").alias("v"), F.max("asked").alias("asked"))


def _members(given: DataFrame, most: int) -> DataFrame:
    """``id, v, node``: of the copies of each vector those with the ``most`` smallest ids.

    Copies are numbered within parts first, so no task sees all copies of a vector.
    """
    few = given.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("part"))
    for keys in (["v", "part"], ["v"]):
        few = few.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).where(F.col("nth") <= most).drop("nth")
    return few.select("id", "v", F.min("id").over(Window.partitionBy("v")).alias("node"))


@F.pandas_udf(T.BinaryType())
def _code(v: pd.Series) -> pd.Series:
    """A vector in one byte a component, after the size of a step (a double)."""
    if not len(v):
        return pd.Series([], dtype=object)
    whole = np.stack(v.to_numpy())
    step = np.abs(whole).max(1) / 127
    step[step == 0] = np.finfo(float).tiny
    signs = np.rint(whole / step[:, None]).clip(-127, 127).astype(np.int8)
    return pd.Series([a.tobytes() + b.tobytes() for a, b in zip(step, signs)])


def _decoded(codes: pd.Series) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    step = np.ascontiguousarray(raw[:, :8]).view(np.float64)
    return raw[:, 8:].view(np.int8) * step


@F.pandas_udf(T.DoubleType())
def _code_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """The squared distance of two coded vectors."""
    if not len(a):
        return pd.Series([], dtype=float)
    return pd.Series(((_decoded(a) - _decoded(b)) ** 2).sum(1))


def build_graph(points: DataFrame, degree: int = DEGREE) -> DataFrame:
    """``id, other, d``: for every point its ``degree`` nearest found, by squared distance of codes.

    Points of a leaf of a few random projection trees start as neighbours. In each round
    every point introduces its neighbours, in both directions, to each other, of whom at
    least one is new to the other; whoever is nearer than the farthest neighbour replaces
    it. The joins are between edges and points; a point sees a sample of ``SAMPLE`` of those
    that have it as a neighbour, as hubs have very many.
    """
    n = points.count()
    if n < 2:
        return points.sparkSession.createDataFrame([], "id long, other long, d double, fresh boolean")
    graph = settle(_nearest_only(_start(points, n, degree), degree).withColumn("fresh", F.lit(True)))
    if n <= LEAF:
        return graph
    for turn in range(_most_rounds(n)):
        found = _introduced(graph, points, turn, max(1, n // HOSTS))
        merged = graph.select("id", "other", "d", F.lit(True).alias("old")).unionByName(found.select("id", "other", "d", F.lit(False).alias("old")))
        merged = merged.groupBy("id", "other").agg(F.min("d").alias("d"), F.max("old").alias("old"))
        graph = settle(_nearest_only(merged, degree).select("id", "other", "d", (~F.col("old")).alias("fresh")))
        changed = graph.agg(F.avg(F.col("fresh").cast("double"))).first()[0] or 0.0
        if changed < LEAST_CHANGE:
            return graph
    raise RuntimeError(f"the neighbour graph of {n} vectors still changes by {changed:.3f} a round")


def _trees(n: int) -> int:
    """Random projection trees to start from: one more for each fourfold number of leaves."""
    return 2 + int(np.log2(max(n / LEAF, 1))) // 2


def _most_rounds(n: int) -> int:
    """A safety stop far above the rounds that a descent takes, which grow with log n."""
    return 20 + 4 * int(np.ceil(np.log2(n)))


def _nearest_only(edges: DataFrame, degree: int) -> DataFrame:
    """The nearest of each point; a few per task and point cross the shuffle."""
    order = Window.partitionBy("id").orderBy("d", "other")
    return edges.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= degree).drop("_nth")


def _start(points: DataFrame, n: int, degree: int) -> DataFrame:
    """Neighbours within leaves: points with the same sides of random planes, in pieces of LEAF.

    A leaf may hold many more points than ``LEAF`` (copies of one vector are always on one
    side of everything), so leaves are dealt out in pieces by a hash of the id.
    """
    planes = max(0, int(np.ceil(np.log2(max(n / LEAF, 1)))))
    size = points.select(F.size("v").alias("n")).agg(F.max("n")).first()[0]
    found = None
    for tree in range(_trees(n)):
        rng = np.random.default_rng(tree)
        normals = rng.standard_normal((planes, size))

        placed = points.withColumn("leaf", _leaf(normals)("v"))
        sizes = placed.groupBy("leaf").count().withColumn("pieces", F.ceil(F.col("count") / (2 * LEAF)))
        placed = placed.join(F.broadcast(sizes) if planes <= 16 else sizes, "leaf")
        placed = placed.withColumn("piece", F.pmod(F.xxhash64("id", F.lit(tree)), F.col("pieces")))
        pairs = placed.select("id", "code", "leaf", "piece").groupBy("leaf", "piece").applyInPandas(_all_near(degree), "id long, other long, d double")
        found = pairs if found is None else found.unionByName(pairs)
    return found.groupBy("id", "other").agg(F.min("d").alias("d"))


def _leaf(normals: np.ndarray):
    """The sides of the planes that a vector lies on, as bits."""

    @F.pandas_udf("long")
    def leaf(v: pd.Series) -> pd.Series:
        if not len(normals) or not len(v):
            return pd.Series(np.zeros(len(v), np.int64))
        return pd.Series((np.stack(v.to_numpy()) @ normals.T > 0) @ (1 << np.arange(len(normals), dtype=np.int64)))

    return leaf


def _all_near(degree: int):
    """The nearest of every point among those of one piece of a leaf."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        ids, v = part["id"].to_numpy(), _decoded(part["code"])
        d = _squares(v, v)
        np.fill_diagonal(d, np.inf)
        keep = min(degree, len(ids) - 1)
        if keep < 1:
            return pd.DataFrame({"id": [], "other": [], "d": []})
        at = np.argpartition(d, keep - 1, axis=1)[:, :keep]
        return pd.DataFrame({"id": np.repeat(ids, keep), "other": ids[at].ravel(), "d": np.take_along_axis(d, at, 1).ravel()})

    return run


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def _introduced(graph: DataFrame, points: DataFrame, turn: int, tables: int) -> DataFrame:
    """New edges from introducing the neighbours of each point to each other."""
    back = graph.select(F.col("other").alias("host"), F.col("id").alias("guest"), "fresh")
    # those who have a hub as neighbour are drawn by lot, reduced before the shuffle
    lot = F.xxhash64("guest", "host", F.lit(turn))
    drawn = Window.partitionBy("host").orderBy("lot")
    back = back.withColumn("lot", lot).withColumn("nth", F.row_number().over(drawn)).where(F.col("nth") <= SAMPLE).drop("lot", "nth")
    there = graph.select(F.col("id").alias("host"), F.col("other").alias("guest"), "fresh")
    party = there.unionByName(back).groupBy("host", "guest").agg(F.max("fresh").alias("fresh"))
    worst = graph.groupBy("id").agg(F.max("d").alias("worst"))
    known = points.join(worst, "id", "left").select(F.col("id").alias("guest"), "code", "worst")
    return party.join(known, "guest").groupBy(F.pmod(F.xxhash64("host"), F.lit(tables)).alias("table")).applyInPandas(_meet, "id long, other long, d double").groupBy("id", "other").agg(F.min("d").alias("d"))


def _meet(part: pd.DataFrame) -> pd.DataFrame:
    """For every host and guest the nearest few other guests that are nearer than its farthest
    neighbour, where one of the two is new."""
    part = part.sort_values("host", kind="stable")
    host, ids = part["host"].to_numpy(), part["guest"].to_numpy()
    vectors = _decoded(part["code"])
    fresh, worst = part["fresh"].to_numpy(dtype=bool), part["worst"].to_numpy(dtype=np.float64)
    edge = np.append(np.flatnonzero(np.concatenate(([True], host[1:] != host[:-1]))), len(host))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in zip(edge, edge[1:]):
        v = vectors[a:b]
        d = _squares(v, v)
        useful = (d < worst[a:b, None]) & (fresh[a:b, None] | fresh[None, a:b])
        np.fill_diagonal(useful, False)
        d[~useful] = np.inf
        keep = min(OFFERS, b - a)
        at = np.argpartition(d, keep - 1, axis=1)[:, :keep] if keep < b - a else np.tile(np.arange(b - a), (b - a, 1))
        near = np.take_along_axis(d, at, 1)
        row, col = np.nonzero(np.isfinite(near))
        out.append((ids[a:b][row], ids[a:b][at[row, col]], near[row, col]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(("id", "other", "d"), columns))).drop_duplicates(["id", "other"])


def search(points: DataFrame, graph: DataFrame, starts: DataFrame, keep: int, beam: int = BEAM) -> DataFrame:
    """``from, node, d``: the ``keep`` nearest found of each of ``starts``, by squared distance of codes.

    Greedy search of the graph from the starts' own nodes, all of them a step at a time,
    until each has opened all of its ``beam`` nearest nodes seen. It goes along edges in both directions, of those that lead to a node the nearest ``DEGREE``.
    """
    back = graph.select(F.col("other").alias("id"), F.col("id").alias("other"), "d")
    edges = settle(graph.select("id", "other").unionByName(_nearest_only(back, DEGREE).select("id", "other")).distinct())
    codes = points.select(F.col("id").alias("node"), F.col("code").alias("_there"))
    asked = starts.select("from", F.col("code").alias("_here"))
    nearest_first = Window.partitionBy("from").orderBy("d", "node")

    def measured(pairs: DataFrame) -> DataFrame:
        both = pairs.join(codes, "node").join(asked, "from")
        return both.select("from", "node", _code_distance("_here", "_there").alias("d"), F.lit(True).alias("open"))

    first = asked.join(edges, F.col("from") == F.col("id")).select("from", F.col("other").alias("node"))
    seen = settle(measured(first))
    while True:  # each step opens nodes for good, so there is an end
        ranked = settle(seen.withColumn("go", (F.row_number().over(nearest_first) <= beam) & F.col("open")))
        go = ranked.where("go").select("from", "node")
        if go.isEmpty():
            break
        onward = go.join(edges, F.col("node") == F.col("id")).select("from", F.col("other").alias("node")).distinct()
        onward = onward.where("from <> node").join(ranked.select("from", "node"), ["from", "node"], "left_anti")
        old = ranked.select("from", "node", "d", (F.col("open") & ~F.col("go")).alias("open"))
        seen = settle(old.unionByName(measured(onward)))
    return seen.withColumn("nth", F.row_number().over(nearest_first)).where(F.col("nth") <= keep).select("from", "node", "d")


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def exact(vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> Iterator[tuple]:
    """What ``nearest`` should find, by comparing with everything; for small tables, to measure recall."""
    rows = [(r["id"], np.array(r["v"])) for r in _points(vectors, vec_id, embedding, queries).collect()]
    asked = {r[0] for r in vectors.where(queries).select(F.col(vec_id).cast("long")).collect()}
    for i, v in rows:
        if i in asked:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in rows if j != i)[:k]
            yield from ((i, rank, j, d) for rank, (d, j) in enumerate(near, 1))

"""Toxicity: a word classifier kept from leaning on identity terms by counterfactuals."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import fresh, settle

# Feature cells. A word gives a cell for itself and one for each of its beginnings.
CELLS = 1 << 18
BEGINNINGS = (4, 5, 6)
# Labelled documents that the classifier is fitted on: those with the smallest hash of their id.
TRAINING_ROWS = 12_000
FOLDS = 5
# Weight of the squared change of the score when an identity term is swapped.
COUNTERFACTUAL_WEIGHT = 2.0
# Standard errors that the shares of a cell among the two labels are apart, at least.
LEAST_Z = 4.5
RIDGE = 1e-4
STEPS = 300

# Terms that name a group without judging it, by kind; a term is swapped with others of its kind.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def cells_of_word(word: str) -> list[int]:
    raw = [word, *[f"{word[:k]}*" for k in BEGINNINGS if len(word) > k]]
    return [zlib.crc32(x.encode("utf-8", "replace")) % CELLS for x in raw]


def cells_of(words: set[str]) -> np.ndarray:
    return np.array(sorted({c for w in words for c in cells_of_word(w)}), np.int32)


def counterfactuals(words: set[str], terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Iterator[set[str]]:
    """The words with one identity term swapped: for each term found, the next of its kind."""
    for kind in terms:
        for i, term in enumerate(kind):
            if term in words:
                yield (words - {term}) | {kind[(i + 1) % len(kind)]}


def held_out(doc_id) -> F.Column:
    """Whether the CRC-32 of the id as text leaves no rest by ``FOLDS``; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = TRAINING_ROWS,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    weight: float = COUNTERFACTUAL_WEIGHT,
) -> Model:
    """A logistic classifier of the words in a document, fitted on rows that are not held out.

    It minimises the weighted log loss, a ridge term, and ``weight`` times the mean squared
    change of the score over the counterfactuals of the training sentences: the documents'
    sentences with an identity term swapped. The swap changes no meaning that the label is
    about, so a change of the score is what a neutral mention of a group would cost.

    At most ``rows`` documents are used, those with the smallest hash of id and text, as many
    of each label as can be; only their cells come to the driver. Rows with a null label or
    text are not used. Without labels the score is 0.5 for all.
    """
    given = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label IS NOT NULL")
    given = given.where(~held_out("_id"))
    lot = F.xxhash64(F.col("_id"))
    # two bounded reports: the first of each label by a hash of the id
    picked = None
    for value in (0, 1):
        some = given.where(F.col("_label") == value).select("_id", "_label", lot.alias("_lot")).orderBy("_lot", "_id").limit(rows // 2)
        picked = some if picked is None else picked.unionByName(some)
    chosen = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).where("_text IS NOT NULL")
    chosen = chosen.join(F.broadcast(picked), "_id")  # at most ``rows`` rows of three numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label_, text_ in zip(batch["_label"].to_pylist(), batch["_text"].to_pylist()):
                words = words_of(text_)
                own = cells_of(words)
                swaps = []
                for other in counterfactuals(words, terms):
                    cells = cells_of(other)
                    swaps.append(np.concatenate([np.setdiff1d(cells, own), -1 - np.setdiff1d(own, cells)]).tolist())
                columns = [pa.array([label_], pa.int32()), pa.array([own.tolist()], pa.list_(pa.int32())), pa.array([swaps], pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(columns, ["label", "cells", "swaps"])

    found = settle(chosen.select("_label", "_text").mapInArrow(run, "label int, cells array<int>, swaps array<array<int>>"))
    n, positive = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    used = _telling_cells(found, n, positive)
    shipped = docs.sparkSession.sparkContext.broadcast(used)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only the cells in use, by their place among them."""
        for batch in batches:
            cells = [places(np.array(c.as_py(), np.int64), shipped.value) for c in batch["cells"]]
            swaps = [[places(np.array(s, np.int64), shipped.value) for s in of_row.as_py()] for of_row in batch["swaps"]]
            columns = [batch["label"], pa.array(cells, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "cells", "swaps"])

    # rows in an order of their own, so that runs agree; ids that come with several texts make more of them
    narrowed = found.mapInArrow(narrow, found.schema).orderBy("label", F.xxhash64("cells"), F.xxhash64("swaps")).limit(2 * rows).toArrow()
    return fit_places(
        np.array(narrowed["label"].to_pylist(), np.float64),
        [np.array(c, np.int64) for c in narrowed["cells"].to_pylist()],
        [np.array(s, np.int64) for swaps in narrowed["swaps"].to_pylist() for s in swaps],
        weight,
        used,
    )


def _telling_cells(found: DataFrame, n: int, positive: int) -> np.ndarray:
    """Cells that come with one label more often than chance has it, counted on the cluster.

    At most ``CELLS`` numbers come to the driver.
    """
    n1, n0 = max(positive, 1), max(n - positive, 1)
    counts = found.select("label", F.explode("cells").alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("seen"), F.sum("label").alias("toxic")
    )
    share = F.col("seen") / F.lit(float(max(n, 1)))
    spread = F.sqrt(F.greatest(share * (1 - share) * (1 / n1 + 1 / n0), F.lit(1e-12)))
    apart = F.abs(F.col("toxic") / n1 - (F.col("seen") - F.col("toxic")) / n0)
    telling = counts.where((F.col("seen") >= 3) & (apart >= LEAST_Z * spread))
    return np.sort(telling.select("cell").toArrow()["cell"].to_numpy().astype(np.int64))


def places(cells: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Places of those of the cells that are in use; -1 - place for those that a swap takes away."""
    if not len(used) or not len(cells):
        return np.empty(0, np.int32)
    whole = np.where(cells >= 0, cells, -1 - cells)
    at = np.minimum(np.searchsorted(used, whole), len(used) - 1)
    return np.where(cells >= 0, at, -1 - at)[used[at] == whole].astype(np.int32)


def fit(labels: np.ndarray, cells: list[np.ndarray], swaps: list[np.ndarray], weight: float) -> Model:
    """``swaps``: cells that a swap adds, and -1 - cell for those that it takes away."""
    flat, owner = _flat(cells)
    seen = np.bincount(flat, minlength=CELLS)
    toxic = np.bincount(flat, weights=labels[owner], minlength=CELLS)
    n1, n0 = max(labels.sum(), 1), max(len(labels) - labels.sum(), 1)
    share = seen / max(len(labels), 1)
    spread = np.sqrt(np.maximum(share * (1 - share) * (1 / n1 + 1 / n0), 1e-12))
    used = np.flatnonzero((seen >= 3) & (np.abs(toxic / n1 - (seen - toxic) / n0) >= LEAST_Z * spread))
    return fit_places(labels, [places(c, used) for c in cells], [places(s, used) for s in swaps], weight, used)


def fit_places(labels: np.ndarray, cells: list[np.ndarray], swaps: list[np.ndarray], weight: float, used: np.ndarray) -> Model:
    """The same with cells by their place among those in use, -1 - place for a cell that is taken away."""
    if not len(labels):
        return Model(np.zeros(CELLS, np.float32), 0.0)
    flat, owner = _flat(cells)
    n, k = len(labels), len(used)
    swap_flat, swap_owner = _flat(swaps)
    swap_sign = np.where(swap_flat >= 0, 1.0, -1.0)
    swap_flat = np.where(swap_flat >= 0, swap_flat, -1 - swap_flat)
    # both labels weigh the same
    positive = labels.sum()
    share = np.where(labels == 1, 0.5 / max(positive, 1), 0.5 / max(n - positive, 1))
    w, b = np.zeros(k), 0.0
    squares, square_b = np.full(k, 1e-8), 1e-8
    for _ in range(STEPS):
        z = np.bincount(owner, weights=w[flat], minlength=n) + b
        slope = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        grad = np.bincount(flat, weights=slope[owner], minlength=k) + RIDGE * w
        if len(swap_flat):
            change = np.bincount(swap_owner, weights=swap_sign * w[swap_flat], minlength=len(swaps))
            grad += weight / len(swaps) * np.bincount(swap_flat, weights=swap_sign * change[swap_owner], minlength=k)
        grad_b = slope.sum()
        squares += grad * grad
        square_b += grad_b * grad_b
        w -= 0.5 * grad / np.sqrt(squares)
        b -= 0.5 * grad_b / np.sqrt(square_b)
    weights = np.zeros(CELLS, np.float32)
    weights[used] = w
    return Model(weights, float(b))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows).astype(np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``score``, from 0 to 1: the chance that the label is 1.

    The whole text counts, each word once. A null or empty text has the score of no words.
    Other columns stay as they are, except one of the name ``score``.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # CELLS numbers

    kept = [c for c in docs.columns if c != "score"]
    name = fresh(docs.columns, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in batches:
            scores = [scorer(t.as_py()) for t in batch[name]]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(scores, pa.float64())], [*kept, "score"])

    schema = T.StructType([*(f for f in docs.schema.fields if f.name in kept), T.StructField("score", T.DoubleType())])
    return docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias(name)).mapInArrow(run, schema)


class Scorer:
    """Scores texts; the summed weights of words are kept at hand, up to a bound."""

    KEPT = 300_000

    def __init__(self, model: Model):
        self.weights, self.bias = model.weights, model.bias
        self.kept: dict[str, float] = {}

    def __call__(self, text: str | None) -> float:
        # words that share a beginning share its cell, which counts once
        total, beginnings = self.bias, set()
        kept = self.kept
        for word in words_of(text):
            found = kept.get(word)
            if found is None:
                if len(kept) >= self.KEPT:
                    kept.clear()
                cells = cells_of_word(word)
                found = kept[word] = (float(self.weights[cells[0]]), tuple(c for c in cells[1:] if self.weights[c] != 0))
            total += found[0]
            if found[1]:
                beginnings.update(found[1])
        total += float(self.weights[list(beginnings)].sum()) if beginnings else 0.0
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))

"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel edit distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits allowed per letter of a test item.
ERROR_RATE = 0.06
# Items whose letters fit in one automaton; more are looked for block by block.
BLOCK_LETTERS = 2_000_000
# An item of fewer letters than this would be found in clean texts by chance, so it has to be
# whole lines or sentences of a text.
LEAST_LETTERS = 24

_NOT_WORD = re.compile(r"[\W_]+")
_ENDS = re.compile(r"""[.!?]+["')\]]*(?=\s|$)|[\n\r\u2028\u2029。！？]""")
_MATCH = "doc_id bigint, item_id bigint, distance int, start int, end int"


def normal_form(text: str | None) -> str:
    """Lower case, every run of what is neither letter nor digit as one space, none at the ends."""
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item: str = "text",
    error_rate: float = ERROR_RATE,
) -> DataFrame:
    """A row ``doc_id, item_id, distance, start, end`` for each test item that a document holds.

    A document holds an item if a substring of its normal form is within
    ``floor(error_rate * length)`` edits of the item's normal form. ``distance`` is the
    smallest there is, ``end`` where the first such substring ends and ``start`` the latest
    start that goes with this end, in the normal form, from 0.

    An item within k edits leaves one of any k + 1 pieces untouched, so the pieces of all
    items are looked for in each whole text in one go, and the distance is taken around
    the hits alone. Items reach the executors in blocks of ``BLOCK_LETTERS`` letters, a
    pass over the documents each; nothing of a document is moved.

    Items shorter than ``LEAST_LETTERS`` in normal form are found without edits, where they
    are one or several whole lines or sentences. Items that are null or have no letters or
    digits match nothing, as do null and empty texts. Equal items are found each under its own id; a repeated row of
    either table repeats its matches. Null ids stay null. Other columns are not looked at.
    """
    tests = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item).alias("item")).where("item IS NOT NULL")
    # the length of a benchmark is known before any text of it is read
    letters = tests.select(F.sum(F.length("item")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-letters // BLOCK_LETTERS))
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("item", "item_id"), F.lit(blocks)) == block) if blocks > 1 else tests
        rows = [(r["item_id"], normal_form(r["item"])) for r in mine.collect()]
        shipped = docs.sparkSession.sparkContext.broadcast([(i, x) for i, x in rows if x])
        here = given.mapInArrow(_finder(shipped, error_rate), _MATCH)
        found = here if found is None else found.unionByName(here)
    return found


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces that make up the item, each with its place; as equal in length as can be."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _finder(shipped, error_rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search([(i, x) for i, x in shipped.value if len(x) >= LEAST_LETTERS], error_rate)
        short: dict[str, list[int]] = {}
        for i, x in shipped.value:
            if len(x) < LEAST_LETTERS:
                short.setdefault(x, []).append(i)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [
                    (doc, *match)
                    for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist())
                    for match in [*search(normal_form(text)), *whole_lines(text, short)]
                ]
                columns = list(zip(*rows)) if rows else [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "distance", "start", "end"]
                )

    return run


def whole_lines(text: str | None, short: dict[str, list[int]]) -> Iterator[tuple[int, int, int, int]]:
    """Matches of short items, given by normal form, that are whole lines or sentences; the first of each."""
    if not short or not text:
        return
    parts = [x for x in map(normal_form, _ENDS.split(text.lower())) if x]
    starts = [0]
    for x in parts:
        starts.append(starts[-1] + len(x) + 1)
    whole, ends, sizes, seen = " ".join(parts), {a - 1 for a in starts[1:]}, {len(x) for x in short}, set()
    for start in starts[:-1]:
        for size in sizes:
            here = whole[start : start + size]
            if start + size in ends and here in short and here not in seen:
                seen.add(here)
                yield from ((i, 0, start, start + size) for i in short[here])


class Search:
    """Finds test items, given as (id, normal form), in normal forms of texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        import ahocorasick

        self.items = [(i, x, int(error_rate * len(x)), _masks(x)) for i, x in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, x, errors, _masks_of_x) in enumerate(self.items):
            for at, piece in pieces(x, errors):
                owners.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owned in owners.items():
            self.automaton.add_word(piece, (len(piece), owned))
        if owners:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        if not len(self.automaton) or not text:
            return
        around: dict[int, list[list[int]]] = {}
        for end, (size, owned) in self.automaton.iter(text):
            start = end + 1 - size
            for n, at in owned:
                _, item, errors, _ = self.items[n]
                low, high = max(0, start - at - errors), min(len(text), start - at + len(item) + errors)
                spans = around.setdefault(n, [])
                if spans and low <= spans[-1][1]:  # hits come from left to right, but for the places in the item
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                else:
                    spans.append([low, high])
        for n, spans in around.items():
            item_id, item, errors, masks = self.items[n]
            best = None
            for low, high in _joined(spans):
                distance, end = nearest(masks, len(item), text[low:high])
                if distance <= errors and (best is None or distance < best[0]):
                    best = distance, low + end
            if best:
                distance, end = best
                # the same from right to left gives the start
                window = text[max(0, end - len(item) - errors) : end][::-1]
                yield item_id, distance, end - _first_of(_masks(item[::-1]), len(item), window, distance), end


def _joined(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return out


def _masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _distances(masks: dict[str, int], m: int, text: str, anchored: bool) -> Iterator[int]:
    """After each letter of the text the smallest distance of the pattern to what ends there.

    Myers' column of differences as bits. ``anchored``: what starts at the text's start.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for c in text:
        eq = masks.get(c, 0)
        x = eq | minus
        d0 = ((((eq & plus) + plus) ^ plus) | x) & full
        up, down = minus | (full & ~(d0 | plus)), d0 & plus
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | (1 if anchored else 0)) & full
        down = (down << 1) & full
        plus, minus = down | (full & ~(d0 | up)), up & d0
        yield score


def nearest(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The smallest distance to any substring, and where the first such ends."""
    best, end = m, 0
    for at, score in enumerate(_distances(masks, m, text, False), 1):
        if score < best:
            best, end = score, at
    return best, end


def _first_of(masks: dict[str, int], m: int, text: str, distance: int) -> int:
    """Length of the shortest prefix of ``text`` at this distance."""
    return next((at for at, score in enumerate(_distances(masks, m, text, True), 1) if score == distance), len(text))

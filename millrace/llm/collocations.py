"""Phrase collocations: fingerprints of all n-grams, counted by a shuffle, checked against text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import narrow_broadcast, settle

# Fixed values of the contract: longest phrase, least count, rows of a language, and the
# percentage of a phrase's occurrences inside a longer one from which it is dropped.
MOST_WORDS, LEAST, TOP, COVERED = 3, 10, 2000, 50

# A phrase is counted if the frequent phrases one word shorter may hold both of its ends.
# They are kept as a table of 2 ** FILTER_BITS bits; the fuller it is, the less it spares.
FILTER_BITS = 26
# Parts in which the phrases of a language are ranked before they are ranked together.
LOTS = 32
# Texts are hashed in slices of about so many bytes that end where a piece ends.
SLICE = 1 << 20
# A task adds up so many fingerprints at once, at least.
AT_ONCE = 1_000_000

_U = np.uint64
# What a byte is: part of a word, space, or end of a piece.
_WORD, _SPACE, _END = 0, 1, 2
_KIND = np.array([_SPACE if c in b"\x20\x09" else _END if c in b".,;:!?\n\x0b\x0c\r" else _WORD for c in range(256)], dtype=np.uint8)
_LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], dtype=np.uint8)
_COUNTS = "fingerprint bigint, n bigint, checks bigint, row bigint"


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    most_words: int = MOST_WORDS,
    least: int = LEAST,
    top: int = TOP,
    covered: int = COVERED,
    bits: int = 64,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """A row ``lang, rank, phrase, a, l, r, n, score`` for each language's best phrases.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends, and those
    into words at spaces and tabs. ``n`` counts the words of a language, ``a`` how often the
    words of a phrase stand consecutively in a piece. A candidate has 2 to ``most_words``
    words and ``a >= least``. Cut after its first words, its parts occur ``l`` and ``r``
    times and score ``10**6 * a * a div (l * r)``; the cut with the lowest score counts,
    the first of equal ones. A candidate goes if a longer one holds its words with at least
    ``covered`` percent of its count. The first ``top`` of a language by score, then ``a``,
    then phrase in byte order, have ranks from 1.

    Every n-gram becomes a fingerprint, the difference of two prefix polynomials over its
    words' fingerprints, which are differences of prefix polynomials over bytes; language
    and all are in it. A shuffle adds up fingerprints that each task has already counted,
    with one row that holds an occurrence and a sum of second, independent fingerprints.
    Only the frequent are looked up in their rows and become text. Where the sum is not
    that of so many times this text, several phrases share the fingerprint, and these are
    counted anew as text. With fewer ``bits`` of a fingerprint that happens more often; the
    result stays the same.

    A phrase is counted only if a table of bits says that both phrases without its first or
    last word may be frequent; a full table spares nothing and drops nothing.

    Null texts are empty, null languages ``und``. Empty texts and tables have no phrases.
    Repeated rows count each. Other columns are not looked at. Memory grows with the
    longest piece, not with the longest text.
    """
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    given = settle(given.withColumn("row", F.monotonically_increasing_id()))
    words, frequent, table = None, [], None
    for k in range(1, most_words + 1):
        counted = given.mapInArrow(_counter(k, bits, table, filter_bits), f"{_COUNTS}, words bigint, lang string")
        totals = counted
        if k == 1:
            # rows of words alone, one for each batch and language
            counted = settle(counted)
            words = settle(counted.where("words IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("n")))
            totals = counted.where("words IS NULL")
        totals = totals.groupBy("fingerprint").agg(F.sum("n").alias("n"), F.sum("checks").alias("checks"), F.min("row").alias("row"))
        totals = settle(totals.where(F.col("n") >= least).withColumn("k", F.lit(k)))
        frequent.append(totals)
        if k < most_words:
            table = docs.sparkSession.sparkContext.broadcast(_bit_table(totals, filter_bits))
    every = frequent[0]
    for totals in frequent[1:]:
        every = every.unionByName(totals)
    phrases = settle(_exact_phrases(given, every, most_words, least, bits))
    return _ranked(phrases, words, least, top, covered)


def _bit_table(totals: DataFrame, filter_bits: int) -> np.ndarray:
    """A bit for the upper bits of each fingerprint; at most ``2 ** filter_bits`` bits come to the driver."""
    cell = F.shiftrightunsigned("fingerprint", 64 - filter_bits)
    marks = totals.groupBy(F.shiftright(cell, 6).cast("int").alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell.bitwiseAND(F.lit(63).cast("long"))).cast("int"))).alias("mark")
    )
    found = marks.toArrow()
    table = np.zeros(max(1, 1 << filter_bits >> 6), dtype=np.int64)
    table[found["at"].to_numpy()] = found["mark"].to_numpy()
    return table.view(np.uint64)


def _exact_phrases(given: DataFrame, every: DataFrame, most_words: int, least: int, bits: int) -> DataFrame:
    """``lang, phrase, k, a``: the frequent n-grams as text, with exact counts."""
    wanted = settle(every.groupBy("row").agg(F.collect_list(F.struct("fingerprint", "n", "checks", "k")).alias("found")))
    rows = narrow_broadcast(wanted.select("row"), wanted.count())
    # a row has at most as many n-grams as its text
    texts = given.join(rows, "row", "left_semi").join(wanted, "row")
    named = settle(texts.select("lang", "text", "found").mapInArrow(_namer(most_words, bits), "lang string, phrase string, k int, a bigint, fingerprint bigint, alone boolean"))
    shared = named.where(~F.col("alone"))
    alone = named.where("alone").select("lang", "phrase", "k", "a")
    ambiguous = shared.select("k", "fingerprint").distinct()
    number = ambiguous.count()
    if not number:
        return alone
    # fingerprints of several phrases: their phrases are counted as text
    marks = [_bit_table(ambiguous.where(F.col("k") == k), 20) for k in range(1, most_words + 1)]
    shipped = given.sparkSession.sparkContext.broadcast(marks)
    spelled = given.select("lang", "text").mapInArrow(_speller(most_words, bits, shipped), "lang string, phrase string, k int, fingerprint bigint, n bigint")
    recounted = (
        spelled.groupBy("lang", "phrase", "k", "fingerprint")
        .agg(F.sum("n").alias("a"))
        .where(F.col("a") >= least)
        .join(narrow_broadcast(ambiguous, number), ["k", "fingerprint"], "left_semi")
    )
    return alone.unionByName(recounted.select("lang", "phrase", "k", "a"))


def _ranked(phrases: DataFrame, words: DataFrame, least: int, top: int, covered: int) -> DataFrame:
    def some(first: Column | int, number: Column | int) -> Column:
        return F.array_join(F.slice("_w", first, number), " ")

    long = phrases.where("k >= 2").withColumn("_w", F.split("phrase", " "))
    # all phrases of two words or more inside a candidate, with the largest count around them
    inner = F.expr(
        "flatten(transform(sequence(2, greatest(k - 1, 2)), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(_w, i, m), ' '))))"
    )
    inside = long.where("k >= 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("around"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left = long.join(inside, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered)
    )
    cuts = left.select("lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", some(1, F.col("cut")).alias("first"), some(F.col("cut") + 1, F.size("_w") - F.col("cut")).alias("rest")
    )
    number = phrases.count()

    def counts(name: str, as_: str) -> DataFrame:
        # phrases of a few words: as many bytes as some numbers
        return narrow_broadcast(phrases.select("lang", F.col("phrase").alias(name), F.col("a").alias(as_)), number * 2)

    scored = cuts.join(counts("first", "l"), ["lang", "first"]).join(counts("rest", "r"), ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    # a is at most l and r, so the score is at most a million
    wide = (a * a).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    scored = scored.withColumn("score", F.call_function("div", wide.cast("decimal(38,0)"), l * r))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("s")).select("lang", "phrase", "s.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of each lot of a language before those of all of it: no task sees all its phrases
    first = lowest.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(LOTS)))
    for keys in (["lang", "lot"], ["lang"]):
        first = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return first.join(narrow_broadcast(words, words.count()), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# fingerprints


def _odd(seed: int) -> int:
    return ((seed * 0x9E3779B97F4A7C15) | 1) % (1 << 64)


class _Base:
    """Powers of an odd number and of its inverse, modulo 2 ** 64, as far as needed."""

    def __init__(self, seed: int):
        self.base = _odd(seed)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, dtype=_U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            size = max(n, 1 << 16)
            self.powers = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, self.base, _U)]))
            self.inverses = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, self.inverse, _U)]))
        return self.powers, self.inverses

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Sums of code times power before each place; differences are the polynomials of what is between."""
        powers, _ = self.upto(len(codes) + 1)
        return np.concatenate([np.zeros(1, _U), np.cumsum(codes * powers[: len(codes)])])

    def between(self, prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inverses = self.upto(len(prefixes))
        return (prefixes[ends] - prefixes[starts]) * inverses[starts]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mapping that lets every bit depend on all."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Fingerprints:
    """The words of some texts, and fingerprints of runs of them.

    ``bits`` are those of a fingerprint; the check beside it always has 24.
    """

    # bytes and words, for the fingerprint and for the check
    _bases = [_Base(s) for s in (3, 5, 7, 11)]

    def __init__(self, texts: list[memoryview | bytes], langs: list[str], bits: int = 64):
        self.bits = bits
        self.data = _LOWER[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
        kind = _KIND[self.data]
        word = kind == _WORD
        edge = np.diff(np.concatenate([[False], word, [False]]).view(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # texts are joined by an end of a piece
        pieces = np.cumsum(kind == _END)[self.starts] if len(self.starts) else np.zeros(0, dtype=np.int64)
        self.pieces = pieces
        limits = np.cumsum([len(t) + 1 for t in texts])
        self.text_of = np.searchsorted(limits, self.starts, side="right")
        seeds = {name: int.from_bytes(name.encode()[:4096] + b"\x01", "big") % ((1 << 61) - 1) for name in set(langs)}
        by_text = np.array([seeds[name] for name in langs], dtype=_U)
        codes = self.data.astype(_U) + _U(1)
        self.seeds = _mixed(by_text)[self.text_of] if len(langs) else np.zeros(0, _U)
        self._prefixes = []
        for of_bytes, of_words in (self._bases[:2], self._bases[2:]):
            words = _mixed(of_bytes.between(of_bytes.prefixes(codes), self.starts, self.ends))
            self._prefixes.append((of_words, of_words.prefixes(words)))

    def places(self, k: int) -> np.ndarray:
        """First words of all runs of ``k`` words within a piece."""
        last = len(self.starts) - k + 1
        if last <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.pieces[:last] == self.pieces[k - 1 :])

    def of(self, at: np.ndarray, k: int, check: bool = False) -> np.ndarray:
        """Fingerprints, or checks, of the runs of ``k`` words from these words on."""
        base, prefixes = self._prefixes[check]
        out = _mixed(base.between(prefixes, at, at + k) + self.seeds[at] + _U(k))
        if check:
            return out >> _U(40)
        return out & _U(((1 << self.bits) - 1) << (64 - self.bits))

    def phrase(self, at: int, k: int) -> str:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(at, at + k)).decode()


def _slices(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows whose first field is a text, in groups of about ``SLICE`` bytes.

    A longer text is cut after ends of pieces; the cut end itself goes.
    """
    group, size = [], 0
    for text, *others in rows:
        at = 0
        while True:
            end = len(text) if len(text) - at <= SLICE else _end_of_piece(text, at + SLICE)
            group.append((text[at:end], *others))
            size += end - at
            at = end + 1
            if size >= SLICE:
                yield group
                group, size = [], 0
            if at >= len(text):
                break
    if group:
        yield group


def _end_of_piece(text: bytes, at: int) -> int:
    while at < len(text):
        ends = np.flatnonzero(_KIND[np.frombuffer(text, dtype=np.uint8, offset=at, count=min(SLICE, len(text) - at))] == _END)
        if len(ends):
            return at + int(ends[0])
        at += SLICE
    return len(text)


def _may_be(table: np.ndarray, fingerprints: np.ndarray, filter_bits: int) -> np.ndarray:
    cell = fingerprints >> _U(64 - filter_bits)
    return (table[cell >> _U(6)] >> (cell & _U(63))) & _U(1) == 1


def _counter(k: int, bits: int, shipped, filter_bits: int):
    """Counts of the fingerprints of runs of ``k`` words; with ``k`` = 1 those of words by language too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value if shipped else None
        for batch in batches:
            fields = (batch.column(name) for name in ("text", "row", "lang"))
            texts, rows, langs = next(fields), next(fields).to_pylist(), next(fields).to_pylist()
            parts, words = [], {}
            for group in _slices((t.as_py(), row, lang) for t, row, lang in zip(texts, rows, langs)):
                of_group = [lang for _, _, lang in group]
                found = Fingerprints([t for t, _, _ in group], of_group, bits)
                at = found.places(k)
                if table is not None and len(at):
                    at = at[_may_be(table, found.of(at, k - 1), filter_bits)]
                    at = at[_may_be(table, found.of(at + 1, k - 1), filter_bits)]
                ids = np.array([row for _, row, _ in group], dtype=np.int64)
                parts.append((found.of(at, k), found.of(at, k, check=True), ids[found.text_of[at]]))
                if k == 1:
                    for lang, n in zip(of_group, np.bincount(found.text_of, minlength=len(group)).tolist()):
                        words[lang] = words.get(lang, 0) + n
                if sum(len(p[0]) for p in parts) >= AT_ONCE:
                    yield from _added_up(parts)
                    parts = []
            yield from _added_up(parts)
            if words:
                empty = pa.nulls(len(words), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [empty, empty, empty, empty, pa.array(list(words.values()), pa.int64()), pa.array(list(words), pa.string())],
                    ["fingerprint", "n", "checks", "row", "words", "lang"],
                )

    return run


def _added_up(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """A row for each fingerprint: its number, the sum of the checks, the first row."""
    if not parts:
        return
    fingerprints, checks, rows = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(fingerprints, kind="stable")
    fingerprints = fingerprints[order]
    first = np.flatnonzero(np.concatenate([[True], fingerprints[1:] != fingerprints[:-1]])) if len(order) else order
    number = np.diff(np.append(first, len(order)))
    sums = np.add.reduceat(checks[order].astype(np.int64), first) if len(order) else first
    lowest = np.minimum.reduceat(rows[order], first) if len(order) else first
    for at in range(0, len(first), 200_000):
        here = slice(at, at + 200_000)
        size = len(first[here])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(fingerprints[first[here]].view(np.int64)),
                pa.array(number[here].astype(np.int64)),
                pa.array(sums[here].astype(np.int64)),
                pa.array(lowest[here].astype(np.int64)),
                pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.string()),
            ],
            ["fingerprint", "n", "checks", "row", "words", "lang"],
        )


def _namer(most_words: int, bits: int):
    """Text of the wanted fingerprints of a row, and whether all their occurrences have this text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            langs, texts, wanted = batch.columns
            for lang, text, of_row in zip(langs.to_pylist(), texts, wanted):
                asked = pa.StructArray.from_arrays(of_row.values.flatten(), names=["fingerprint", "n", "checks", "k"])
                left = [asked.field(i).to_numpy() for i in range(4)]
                for group in _slices(iter([(text.as_py(), lang)])):
                    found = Fingerprints([t for t, _ in group], [x for _, x in group], bits)
                    rest = np.ones(len(left[0]), dtype=bool)
                    for k in range(1, most_words + 1):
                        mine = np.flatnonzero(left[3] == k)
                        at = found.places(k)
                        if not len(mine) or not len(at):
                            continue
                        prints = found.of(at, k).view(np.int64)
                        order = np.argsort(prints, kind="stable")
                        place = np.minimum(np.searchsorted(prints[order], left[0][mine]), len(at) - 1)
                        here = at[order][place]
                        met = found.of(here, k).view(np.int64) == left[0][mine]
                        checks = found.of(here, k, check=True).astype(np.int64)
                        for i, word, check in zip(mine[met].tolist(), here[met].tolist(), checks[met].tolist()):
                            print_, n, sums = int(left[0][i]), int(left[1][i]), int(left[2][i])
                            out.append((lang, found.phrase(word, k), k, n, print_, sums == n * check))
                        rest[mine[met]] = False
                    left = [x[rest] for x in left]
                    if not len(left[0]):
                        break
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            names = ["lang", "phrase", "k", "a", "fingerprint", "alone"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    return run


def _speller(most_words: int, bits: int, shipped):
    """Counts of the texts of all runs of words whose fingerprint may be one of those asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.columns
            for group in _slices((t.as_py(), lang) for t, lang in zip(texts, langs.to_pylist())):
                found = Fingerprints([t for t, _ in group], [x for _, x in group], bits)
                counts: dict[tuple, int] = {}
                for k in range(1, most_words + 1):
                    at = found.places(k)
                    at = at[_may_be(shipped.value[k - 1], found.of(at, k), 20)] if len(at) else at
                    prints = found.of(at, k).view(np.int64)
                    for word, print_ in zip(at.tolist(), prints.tolist()):
                        key = (group[found.text_of[word]][1], found.phrase(word, k), k, print_)
                        counts[key] = counts.get(key, 0) + 1
                columns = list(zip(*counts)) if counts else [()] * 4
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(list(counts.values()), pa.int64())], ["lang", "phrase", "k", "fingerprint", "n"]
                )

    return run

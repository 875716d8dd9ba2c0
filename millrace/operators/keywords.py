"""Keyword counts from searches, product statistics and texts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times, words
from millrace.operators.joins import broadcast_if_small


def search_terms(pages: DataFrame) -> DataFrame:
    """What was searched for: the item of a result-list page."""
    searched = (F.col("page_id") == "good_list") & F.col("item").isNotNull()
    if pages.isStreaming:
        # a filter that names the event time is not moved below the watermark, so that
        # every page advances it, not only the searches
        term = F.when(F.col("event_time").isNotNull() & searched, F.col("item"))
        return pages.select(term.alias("fullword"), "event_time").where("fullword IS NOT NULL")
    return pages.where(searched).select(F.col("item").alias("fullword"), "event_time")


def split_keywords(rows: DataFrame, text: str, terms: Sequence[str] = ()) -> DataFrame:
    """One row per word of ``text``, named ``keyword``; rows without words vanish."""
    kept = [c for c in rows.columns if c != text]
    split = rows.select(*kept, words.word_rows(F.col(text), terms).alias("keyword"))
    return split.withColumn("keyword", words.normal_form(F.col("keyword")))


def keyword_stats(keywords: DataFrame, source: str = schemas.KEYWORD_SEARCH, size: str = "10 seconds") -> DataFrame:
    """Occurrences per keyword and window."""
    return (
        keywords.groupBy(F.window("event_time", size), "keyword")
        .agg(F.count(F.lit(1)).alias("ct"))
        .select("keyword", "ct", F.lit(source).alias("source"), *times.window_bounds())
    )


def counts_to_rows(rows: DataFrame, click: str = "click_ct", cart: str = "cart_ct", order: str = "order_ct") -> DataFrame:
    """Up to three rows ``ct, source`` per row, one for each count above zero."""
    kept = [c for c in rows.columns if c not in (click, cart, order)]
    pair = (
        f"stack(3, {click}, '{schemas.KEYWORD_CLICK}', {cart}, '{schemas.KEYWORD_CART}', "
        f"{order}, '{schemas.KEYWORD_ORDER}') AS (ct, source)"
    )
    return rows.selectExpr(*kept, pair).where("ct > 0")


def product_keywords(stats: DataFrame, terms: Sequence[str] = ()) -> DataFrame:
    """Words of the product names with the click, cart and order counts of the product."""
    feed = stats.select("spu_name", "click_ct", "cart_ct", "order_ct", "stt", "edt")
    # counts first: products without any give no row and their name is never split
    return split_keywords(counts_to_rows(feed), "spu_name", terms).select("keyword", "ct", "source", "stt", "edt")


def text_keywords(texts: DataFrame, text: str = "text", by: Sequence[str] = (), terms: Sequence[str] = ()) -> DataFrame:
    """Occurrences per keyword over whole texts."""
    found = split_keywords(texts.select(*by, text), text, terms)
    return found.groupBy(*by, "keyword").agg(F.count(F.lit(1)).alias("ct"))


# Runs are looked at in blocks of so many characters.
BLOCK = 256

# A task has the runs of about so many characters.
CHARACTERS_PER_TASK = 500_000


def dictionary_keywords(rows: DataFrame, text: str, dictionary: DataFrame, lattice: bool = False) -> DataFrame:
    """As ``split_keywords``, Chinese runs split by the words of a dictionary table.

    ``dictionary`` has a column ``word`` and may be of any size. Every distinct run is
    split once, however often it occurs: the pieces that start at each of its characters,
    of every length that a word of the dictionary has, are matched by an equi-join. One
    aggregation over the texts counts the characters of all runs beforehand, for the number
    of tasks. Where
    no match spans a place, the run is cut. A part of overlapping matches is split from
    left to right by the longest match; with ``lattice`` by the matches that cover most of
    its characters, of those by the fewest, and of those by the longest word first, then
    the longest second, and so on. Characters outside become words of their own.
    """
    mixed_run = F.lit(f"{words.LATIN_RUN}|{words.CJK_CHAR}+")
    kept = [c for c in rows.columns if c != text]
    pieces = rows.select(*kept, F.explode(F.regexp_extract_all(text, mixed_run, F.lit(0))).alias("_run"))
    latin = pieces.where(~F.col("_run").rlike(words.CJK_CHAR)).select(*kept, F.lower("_run").alias("keyword"))
    chinese = pieces.where(F.col("_run").rlike(words.CJK_CHAR)).withColumn("_id", _run_id(F.col("_run")))

    occurring = rows.select(F.explode(F.regexp_extract_all(text, F.lit(f"{words.CJK_CHAR}+"), F.lit(0))).alias("_run"))
    runs = occurring.distinct().withColumn("_id", _run_id(F.col("_run")))
    split = _split_runs(runs, dictionary, lattice, _tasks(occurring))
    found = chinese.select(*kept, "_id").join(split, "_id").select(*kept, "keyword")
    return latin.unionByName(found)


def _tasks(occurring: DataFrame) -> int:
    """So many tasks that each has a bounded number of characters: a row each, they take far
    more memory than the size of the text lets Spark expect."""
    characters = occurring.agg(F.sum(F.length("_run"))).first()[0] or 0
    return max(1, -(-characters // CHARACTERS_PER_TASK))


def _run_id(run: Column) -> Column:
    """A short run is its own id, a long one goes by its digest."""
    return F.when(F.length(run) <= 64, run).otherwise(F.sha2(run, 256))


def _split_runs(runs: DataFrame, dictionary: DataFrame, lattice: bool, tasks: int) -> DataFrame:
    """``_id, keyword``: the words of each run, in a time linear in its length."""
    vocabulary = dictionary.where(F.length("word") > 1).select(F.col("word").alias("_word")).distinct()
    # as many numbers as there are different lengths of words, few whatever the dictionary
    lengths = vocabulary.agg(F.collect_set(F.length("_word"))).scalar()
    longest = vocabulary.agg(F.coalesce(F.max(F.length("_word")), F.lit(1))).scalar()
    # a block also has the characters of words that begin in it and end behind it
    block = F.col("_block") * BLOCK
    blocks = runs.select("_id", "_run", F.explode(F.sequence(F.lit(0), F.floor((F.length("_run") - 1) / BLOCK))).alias("_block"))
    blocks = blocks.select(
        "_id", block.alias("_from"), F.substring("_run", (block + 1).cast("int"), F.lit(BLOCK - 1) + longest).alias("_part")
    )
    # few bytes become many rows from here on
    blocks = blocks.repartition(tasks, "_id", "_from")
    last = F.least(F.lit(BLOCK), F.length("_part")) - 1
    starts = blocks.select("_id", "_from", "_part", F.explode(F.sequence(F.lit(0), last)).alias("_in"))
    # the last characters of a block that goes on are the first of the next one
    char = F.expr("substring(_part, _in + 1, 1)")
    # where a length does not fit, the character is the piece, which is no word of the vocabulary
    fits = F.col("_in") + F.col("_size") <= F.length("_part")
    piece = F.when(fits, F.expr("substring(_part, _in + 1, _size)")).otherwise(char)
    tries = starts.select("*", F.explode_outer(lengths).alias("_size"))
    tries = tries.select("_id", "_from", "_in", char.alias("_char"), piece.alias("_piece"))
    matched = tries.join(broadcast_if_small(vocabulary), F.col("_piece") == F.col("_word"), "left")
    # a row per character with the lengths of the words that begin there
    lattice_rows = (
        matched.groupBy("_id", "_from", "_in")
        .agg(F.max("_char").alias("_char"), F.array_sort(F.collect_list(F.length("_word"))).alias("_sizes"))
        .select("_id", (F.col("_from") + F.col("_in")).alias("_at"), "_char", "_sizes")
        .repartition(tasks, "_id")
    )
    # how far the words that begin before a character reach: it begins a part if not to it
    in_order = Window.partitionBy("_id").orderBy("_at")
    end = F.when(F.size("_sizes") > 0, F.col("_at") + F.array_max("_sizes"))
    reach = F.coalesce(F.max(end).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (F.col("_reach") <= F.col("_at")).alias("_begins")
    parts = lattice_rows.withColumn("_reach", reach).select("_id", "_at", "_char", "_sizes", begins)
    alone = F.col("_begins") & (F.size("_sizes") == 0)
    singles = parts.where(alone).select("_id", F.col("_char").alias("keyword"))
    part = F.max(F.when(F.col("_begins"), F.col("_at"))).over(in_order)
    spans = (
        parts.withColumn("_first", part)
        .where(~alone)
        .groupBy("_id", "_first")
        # one entry per character of a part: never larger than the text it comes from
        .agg(F.array_sort(F.collect_list(F.struct("_at", "_char", "_sizes"))).alias("_chars"))
    )
    chosen = F.pandas_udf(_lattice_paths if lattice else _longest_matches, "array<string>")
    of_spans = spans.select("_id", F.explode(chosen("_chars._char", "_chars._sizes")).alias("keyword"))
    return singles.unionByName(of_spans)


def _longest_matches(chars: pd.Series, sizes: pd.Series) -> pd.Series:
    def follow(text: Sequence[str], options: Sequence[Sequence[int]]) -> list[str]:
        out, at = [], 0
        while at < len(text):
            size = max(options[at], default=1)
            out.append("".join(text[at : at + size]))
            at += size
        return out

    return pd.Series([follow(t, o) for t, o in zip(chars, sizes)])


def _lattice_paths(chars: pd.Series, sizes: pd.Series) -> pd.Series:
    return pd.Series([best_path(list(t), [list(o) for o in options]) for t, options in zip(chars, sizes)])


def best_path(chars: list[str], options: list[list[int]]) -> list[str]:
    """Words of a text, given the lengths of the dictionary's words that begin at each character.

    From right to left, for each place the best of what is left: characters covered, words
    (fewer are better), length of the first word.
    """
    best: list[tuple[int, int, int]] = [(0, 0, 0)] * (len(chars) + 1)
    for at in range(len(chars) - 1, -1, -1):
        covered, number, _ = best[at + 1]
        here = (covered, number - 1, 1)
        for size in options[at]:
            covered, number, _ = best[at + size]
            here = max(here, (covered + size, number - 1, size))
        best[at] = here
    out, at = [], 0
    while at < len(chars):
        size = best[at][2]
        out.append("".join(chars[at : at + size]))
        at += size
    return out

"""Keyword expressions: text to an array of words."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scripts that are written without spaces are split by character; runs of all other letters,
# with their marks, and of digits are words.
CJK_CHAR = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
LATIN_RUN = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+"
# The same where a text has none of these scripts, and where it is ASCII.
_ANY_RUN, _ASCII_RUN = r"[\p{L}\p{M}\p{N}]+", "[A-Za-z0-9]+"
# The three scripts begin here.
_FIRST_CJK = r"[\x{2E80}-\x{10FFFF}]"

# Overlapping pairs of Chinese characters; one on its own stays as it is. The word is
# captured ahead, then a Latin run or one character is consumed.
_PAIR = f"{CJK_CHAR}{{2}}"
_ALONE = f"(?<!{CJK_CHAR}){CJK_CHAR}(?!{CJK_CHAR})"
_LATIN_OR_PAIR = f"(?=({LATIN_RUN}|{_PAIR}|{_ALONE}))(?:{LATIN_RUN}|{CJK_CHAR})"

# One alternation is tried word by word at every position, so it is for short lists;
# larger vocabularies go through operators.keywords.dictionary_keywords.
MAX_INLINE_TERMS = 2_000


def words(text: Column, terms: Sequence[str] = ()) -> Column:
    """Array of the words of ``text``, in reading order, repeats kept.

    Letter and digit runs become one word each. Chinese runs become the longest match at
    each position against ``terms`` (single characters where nothing matches), or
    overlapping character pairs when no terms are given.
    """
    if terms:
        if len(terms) > MAX_INLINE_TERMS:
            raise ValueError(f"more than {MAX_INLINE_TERMS} terms: use dictionary_keywords")
        # alternatives are tried in order, so longest first gives the longest match
        listed = "|".join(re.escape(t) for t in sorted(set(terms), key=lambda t: (-len(t), t)))
        mixed = F.regexp_extract_all(text, F.lit(f"{listed}|{LATIN_RUN}|{CJK_CHAR}"), F.lit(0))
    else:
        mixed = F.regexp_extract_all(text, F.lit(_LATIN_OR_PAIR), F.lit(1))
    # script properties are slow: most texts are told by their length in bytes, most others
    # by a range of characters
    plain = F.regexp_extract_all(text, F.lit(_ASCII_RUN), F.lit(0))
    latin = F.regexp_extract_all(text, F.lit(_ANY_RUN), F.lit(0))
    is_plain = F.octet_length(text) == F.length(text)
    return F.when(is_plain, plain).when(text.rlike(_FIRST_CJK) & text.rlike(CJK_CHAR), mixed).otherwise(latin)


def word_rows(text: Column, terms: Sequence[str] = ()) -> Column:
    """One row per word; a text without words gives no row. Lower-case with ``normal_form``."""
    return F.explode(words(text, terms))


def normal_form(word: Column) -> Column:
    return F.lower(word)

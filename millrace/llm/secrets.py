"""Secret scans in DataFrame functions: patterns, and a randomness test battery."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import EDGE, OTHER, PART, let, matches, outside, quoted, running_max
from millrace.llm.tables import fresh, settle

# The patterns of the base spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LEAST_ASSIGNED = 8

# A candidate of the battery: an unbroken run of letters, digits and a few signs.
LEAST_RANDOM = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Candidates by inferred encoding: the narrowest alphabet that holds them.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower base32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
# Share of truly random candidates among those dismissed in a class of length, at most.
FALSE_DISCOVERY = 0.05
# p values are counted in steps of 1 / CELLS of -log10 p, up to MOST_LOG.
CELLS, MOST_LOG = 50, 20
# Kinds of spans, in the order in which those with one start are listed.
KINDS = ("assign", "access", "hex", "random")

_SPAN = "struct<start: int, end: int, kind: string>"


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``secrets``, an array of ``start, end, kind`` in order.

    Starts and ends count code points, ends are exclusive. Kinds: ``assign`` (a named value
    of 8 or more characters), ``access`` (an access key id), ``hex`` (32 or more hex digits),
    leftmost and not overlapping within a kind, and ``random``: runs of 20 or more
    characters of one encoding with at least one digit and one letter that the battery
    finds no structure in, where no other span holds them.

    The battery tests each candidate against uniform random characters of the narrowest of
    the ``ALPHABETS`` that holds it: chi-squared over the alphabet, the number of runs above
    and below its middle, and the correlation of neighbours. The smallest of the three p
    values, times three, is the evidence of structure. Candidates are dismissed by the
    Benjamini and Hochberg rule at ``FALSE_DISCOVERY``, among all candidates of the table
    with a length in the same power of two: short ones show less, so they need their own
    limit.

    Rows are written once with their base spans and candidates; the limits are taken from
    there, and spans chosen by them when the rows are read again.

    A null or empty text has no spans. Repeated rows are each scanned, and counted. Other
    columns stay as they are, except one of the name ``secrets``, which is replaced. An
    empty table gives no rows.
    """
    kept = [c for c in docs.columns if c != "secrets"]
    raw, clean, base, tried = (fresh(docs.columns, name) for name in ("raw", "clean", "base", "tried"))
    # a generator keeps the expression from being copied into each of its uses
    cleaned = F.translate(F.col(text), EDGE + PART, OTHER * 2)
    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.explode(F.array(cleaned)).alias(clean))
    # cheap tests of the text spare most texts everything else
    named = f"(contains({clean}, '=') OR contains({clean}, ':')) AND {clean} RLIKE {quoted(ASSIGN)}"
    spans = [
        f"IF({named}, {_assigned(clean)}, array())",
        f"IF(contains({clean}, 'AKIA'), {_plain(clean, ACCESS, 'access')}, array())",
        f"IF({clean} RLIKE {quoted(HEX)}, {_plain(clean, HEX, 'hex')}, array())",
    ]
    none = "CAST(array() AS array<struct<start: int, end: int, class: int, cell: int>>)"
    mixed = f"{clean} RLIKE '[0-9]' AND {clean} RLIKE '[A-Za-z0-9+/_-]{{{LEAST_RANDOM}}}'"
    found = given.select(
        *(F.col(f"`{c}`") for c in kept),
        F.expr(f"concat({', '.join(f'CAST({s} AS array<{_SPAN}>)' for s in spans)})").alias(base),
        F.expr(f"IF({mixed}, {_candidates(clean)}, {none})").alias(tried),
    )
    found = settle(found)
    cells = found.select(F.explode(tried).alias("c")).groupBy(F.col("c.class").alias("class"), F.col("c.cell").alias("cell"))
    limits = _limits(cells.agg(F.count(F.lit(1)).alias("n")))
    above = CELLS * MOST_LOG + 1
    limit = f"CASE c.class {' '.join(f'WHEN {k} THEN {v}' for k, v in limits.items())} ELSE {above} END" if limits else str(above)
    random = f"transform(filter({tried}, c -> c.cell < {limit}), c -> named_struct('start', c.start, 'end', c.end, 'kind', 'random'))"
    rank = f"array_position(array({', '.join(quoted(k) for k in KINDS)}), s.kind)"
    ordered = f"array_sort(transform(concat({base}, {outside(random, base)}), s -> named_struct('start', s.start, 'rank', {rank}, 'end', s.end, 'kind', s.kind)))"
    spans_of = F.expr(
        f"coalesce(IF(size({tried}) + size({base}) = 0, {base}, "
        f"transform({ordered}, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind))), CAST(array() AS array<{_SPAN}>))"
    )
    return found.select(*(F.col(f"`{c}`") for c in kept), spans_of.alias("secrets"))


def redact(docs: DataFrame, text: str = "text", with_: str = "[SECRET]") -> DataFrame:
    """The rows with every span of ``secrets`` (as from ``scan_secrets``) replaced in the text.

    Spans that overlap or touch are replaced once. Texts without spans, null ones too, stay.
    """
    # up to where earlier spans reach; a piece of text stands before a span that starts beyond
    reach = running_max("transform(secrets, s -> s.end)")

    def written(ends: str, part: str) -> str:
        before = f"IF(i = 0, 0, {ends}[i - 1])"
        between = part.format(start=before, size=f"s.start - {before}")
        piece = f"IF(i > 0 AND s.start <= {before}, '', concat({between}, {quoted(with_)}))"
        rest = part.format(start=f"{ends}[size(secrets) - 1]", size=f"length(`{text}`) - {ends}[size(secrets) - 1]")
        return f"concat(array_join(transform(secrets, (s, i) -> {piece}), ''), {rest})"

    few = let(reach, lambda ends: written(ends, f"substring(`{text}`, {{start}} + 1, {{size}})"))
    # a substring is counted off from the start of the text; for many it is taken apart once
    many = let(f"split(`{text}`, '')", lambda c: let(reach, lambda ends: written(ends, f"array_join(slice({c}, {{start}} + 1, {{size}}), '')")))
    n = F.size("secrets")
    return docs.withColumn(text, F.when(n > 64, F.expr(many)).when(n > 0, F.expr(few)).otherwise(F.col(f"`{text}`")))


def _limits(counts: DataFrame) -> dict[int, int]:
    """Per class of length the smallest cell that is dismissed.

    The counts are at most ``CELLS * MOST_LOG + 1`` rows for each of the few classes.
    """
    rows = counts.collect()
    out = {}
    for name in sorted({r["class"] for r in rows}):
        cells = sorted(((r["cell"], r["n"]) for r in rows if r["class"] == name), reverse=True)
        of_all, seen = sum(n for _, n in cells), 0
        for cell, n in cells:
            seen += n
            if 10 ** (-cell / CELLS) <= FALSE_DISCOVERY * seen / of_all:
                out[name] = cell
    return out


def _length(p: str) -> str:
    """Of a piece, without our own marks."""
    return f"length(replace({p}, '{PART}', ''))"


def _plain(clean: str, pattern: str, kind: str) -> str:
    marked = f"regexp_replace({clean}, {quoted(pattern)}, '{EDGE}$0{EDGE}')"
    return f"transform({matches(marked, 'length({p})')}, m -> named_struct('start', m.start, 'end', m.start + length(m.piece), 'kind', '{kind}'))"


def _assigned(clean: str) -> str:
    marked = f"regexp_replace({clean}, {quoted(ASSIGN)}, '{EDGE}$1{PART}$2{EDGE}')"
    long_enough = f"filter({matches(marked, _length('{p}'))}, m -> length(element_at(split(m.piece, '{PART}'), -1)) >= {LEAST_ASSIGNED})"
    return f"transform({long_enough}, m -> named_struct('start', m.start, 'end', m.start + {_length('m.piece')}, 'kind', 'assign'))"


def _candidates(clean: str) -> str:
    """``start, end, class, cell`` of every candidate of the battery; cell 0 shows no structure."""
    marked = f"regexp_replace({clean}, {quoted(CANDIDATE)}, '{EDGE}$0{EDGE}')"
    found = f"filter({matches(marked, 'length({p})')}, m -> m.piece RLIKE '[0-9]' AND m.piece RLIKE '[A-Za-z]')"
    cell = f"CAST(least(floor(-log10(greatest({p_value('m.piece')}, 1e-{MOST_LOG})) * {CELLS}), {CELLS * MOST_LOG}) AS int)"
    return (
        f"transform({found}, m -> named_struct('start', m.start, 'end', m.start + length(m.piece), "
        f"'class', CAST(floor(log2(length(m.piece))) AS int), 'cell', {cell}))"
    )


def p_value(token: str) -> str:
    """Chance that random characters look as structured as this, by the worst of three tests."""

    def tested(body: str) -> str:
        fits = " ".join(f"WHEN NOT {body} RLIKE '[^{a}]' THEN '{a}'" for a in ALPHABETS.values())
        return let(f"CASE {fits} ELSE '{ALPHABETS['base64']}' END", lambda alphabet: _battery(body, alphabet))

    return let(f"translate(trim(TRAILING '=' FROM {token}), '-_', '+/')", tested)


def _battery(body: str, alphabet: str) -> str:
    """The three tests of a text against uniform characters of an alphabet, whatever its size."""
    k, n = f"CAST(length({alphabet}) AS double)", f"CAST(length({body}) AS double)"
    codes = f"transform(split({body}, ''), c -> CAST(instr({alphabet}, c) AS double) - 1)"

    def scores(k: str, n: str, x: str) -> str:
        # every character's number less one n-th of the whole, squared
        counts = f"aggregate(split({alphabet}, ''), 0D, (a, c) -> a + pow({n} - length(replace({body}, c, '')), 2))"
        chi = f"greatest({counts} * {k} / {n} - {n}, 0D)"
        # Wilson and Hilferty: the cube root of a chi-squared mean is nearly normal
        spread = f"(2D / (9 * ({k} - 1)))"
        uniform = f"(cbrt({chi} / ({k} - 1)) - (1 - {spread})) / sqrt({spread})"
        first, second = f"slice({x}, 1, size({x}) - 1)", f"slice({x}, 2, size({x}) - 1)"
        # a run ends where neighbours lie on two sides of the middle: at every second place
        # (no alphabet has an odd number of characters)
        changed = f"zip_with({first}, {second}, (a, b) -> IF((a >= {k} / 2) = (b >= {k} / 2), 0D, 1D))"
        runs = f"abs(aggregate({changed}, 0D, (s, y) -> s + y) - ({n} - 1) / 2) / sqrt(({n} - 1) / 4)"
        # neighbours of independent uniform characters: products about the middle have mean 0
        products = f"zip_with({first}, {second}, (a, b) -> (a - ({k} - 1) / 2) * (b - ({k} - 1) / 2))"
        serial = f"abs(aggregate({products}, 0D, (s, y) -> s + y)) / (sqrt({n} - 1) * ({k} * {k} - 1) / 12)"
        sided = f"transform(array({uniform}, {runs}, {serial}), (z, i) -> {let('abs(z)', lambda a: _upper_tail('z', a))} * IF(i = 0, 1, 2))"
        return f"least(1D, 3 * array_min({sided}))"

    return let(k, lambda k: let(n, lambda n: let(codes, lambda x: scores(k, n, x))))


def _upper_tail(z: str, size: str) -> str:
    """Chance of a normal value above ``z``, after Abramowitz and Stegun 26.2.17."""

    def tail(t: str) -> str:
        series = "0D"
        for factor in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
            series = f"({factor}D + {series}) * {t}"
        here = f"exp(-{size} * {size} / 2) / {math.sqrt(2 * math.pi)}D * {series}"
        return let(here, lambda p: f"IF({z} >= 0, {p}, 1 - {p})")

    return let(f"1 / (1 + 0.2316419D * {size})", tail)

"""Places of matches within a text as array functions, in a time linear in the matches but for a logarithm.

Everything here is SQL text with names of columns and lambda variables, as expressions of
this depth take long to put together call by call.
"""

from __future__ import annotations

from itertools import count

# One code point each, put around matches and between parts of them; no pattern matches them.
EDGE, PART, OTHER = map(chr, (0xE000, 0xE001, 0xE002))

_numbers = count()


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, body) -> str:
    """``body`` of a name that stands for ``value``, which is computed once."""
    name = f"v{next(_numbers)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def running(array: str, step: str, nothing: str) -> str:
    """Sums (``step`` of ``a`` and ``b``) of all up to each element, by doubling the reach of each.

    ``nothing`` is the element that changes no sum.
    """

    def body(x: str) -> str:
        s, j, a, b = (f"{n}{next(_numbers)}" for n in "sjab")
        moved = f"concat(array_repeat({nothing}, shiftleft(1, {j})), slice({s}, 1, size({s}) - shiftleft(1, {j})))"
        rounds = f"sequence(0, CAST(ceil(log2(size({x}))) AS int) - 1)"
        doubled = f"aggregate({rounds}, {x}, ({s}, {j}) -> zip_with({moved}, {s}, ({a}, {b}) -> {step.format(a=a, b=b)}))"
        return f"IF(size({x}) < 2, {x}, {doubled})"

    return let(array, body)


def running_sum(array: str) -> str:
    return running(array, "{a} + {b}", "0")


def running_max(array: str) -> str:
    """Of non-negative numbers."""
    return running(array, "greatest({a}, {b})", "0")


def matches(marked: str, length: str) -> str:
    """``start, piece`` of the matches in a text with an ``EDGE`` at both ends of each.

    ``length`` measures a piece, named ``{p}``; starts are sums of it.
    """

    def places(pieces: str) -> str:
        p, q, i, m = (f"{n}{next(_numbers)}" for n in "pqim")
        lengths = f"transform({pieces}, {p} -> {length.format(p=p)})"

        def found(ends: str) -> str:
            here = f"named_struct('start', {ends}[{i} - 1], 'piece', {q}, 'odd', {i} % 2 = 1)"
            return f"filter(transform({pieces}, ({q}, {i}) -> IF({i} = 0, named_struct('start', 0, 'piece', {q}, 'odd', false), {here})), {m} -> {m}.odd)"

        return let(running_sum(lengths), found)

    return let(f"split({marked}, '{EDGE}', -1)", places)


def outside(places: str, others: str) -> str:
    """Those of ``places`` that none of ``others`` holds whole, nor a longer one of themselves.

    Both are arrays with ``start, end``; of equal places the first stays. The result is in
    order of start.
    """

    def kept(events: str) -> str:
        e, x, i, y, z = (f"{n}{next(_numbers)}" for n in "exiyz")

        def alone(ends: str) -> str:
            told = f"named_struct('nr', {x}.nr, 'alone', {x}.own AND ({i} = 0 OR {ends}[{i} - 1] < {x}.end))"
            return f"transform(filter(transform({events}, ({x}, {i}) -> {told}), {y} -> {y}.alone), {z} -> {z}.nr)"

        return let(running_max(f"transform({events}, {e} -> {e}.end)"), alone)

    a, i, b, z = (f"{n}{next(_numbers)}" for n in "aibz")

    def both(p: str) -> str:
        # what comes earlier in this order starts no later, and ends no earlier at the same start
        event = "named_struct('start', {0}.start, 'back', -{0}.end, 'own', {1}, 'nr', {2}, 'end', {0}.end)"
        own = f"transform({p}, ({a}, {i}) -> {event.format(a, 'true', i)})"
        given = f"transform({others}, {b} -> {event.format(b, 'false', -1)})"
        return f"IF(size({p}) = 0, {p}, transform({let(f'array_sort(concat({given}, {own}))', kept)}, {z} -> {p}[{z}]))"

    return let(places, both)

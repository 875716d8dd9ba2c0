"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import fresh

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
# What a page shows besides its main text, whatever its density.
ASIDE = frozenset("head nav header footer aside form script style noscript template button select textarea input label fieldset iframe object embed svg canvas audio video map dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
# Parts of a text, never the whole.
PARTS = frozenset("p li ul ol dl dt dd br h1 h2 h3 h4 h5 h6 table tbody thead tr td th blockquote pre figure figcaption".split())
# Elements that a new one of the same row closes, up to the nearest of the elements behind.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Aside elements that may be around the whole page, as may be those with the names below.
WRAPPERS = frozenset("form fieldset header".split())
# Share of the unlinked characters of the body from which on such a wrapper is main text.
MAIN_SHARE = 0.4
# Names of classes and ids that say the same as the elements above.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|"
    r"subscribe|signup|sidebar|side|widget|menu|nav\w*|breadcrumbs?|footer|header|masthead|copyright|related|"
    r"recommend\w*|share|sharing|social|comments?|disqus|replies|respond|login|search|pagination|pager|toolbar|skip)(?:$|[\s_-])",
    re.I,
)

# Those of them that stand in names of parts of a text too, and words about layout alone.
AMBIGUOUS = frozenset("banner copyright header login menu nav notice promo related replies respond search share sharing side skip social toolbar widget".split())
LAYOUT = re.compile(r"\d+|js|is|has|box|block|section|container|wrap(?:per)?|area|inner|outer|list|items?|group|posts?|articles?|stor(?:y|ies)|links?|buttons?|bar|left|right|top|bottom|main|content|form|title|icons?|row|col(?:umn)?|news|more|text|site|page|global|primary|secondary|fixed|sticky|mobile|desktop")
# What makes such a part of an article text: at most this share of links, at least so many characters a tag.
LINKED_SHARE, LEAST_DENSITY = 0.3, 20

_SPACE = re.compile(r"[\s\x00]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass(eq=False)
class Node:
    """An element with its children and texts in page order, and the sums below it."""

    name: str
    marks: str = ""
    children: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


class _Open:
    """The open elements, with the depths of each name and of all blocks, so that the nearest
    of a kind is found without a walk."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.name, []).append(len(self.stack))
        if node.name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        """Close all elements from this depth on."""
        while len(self.stack) > depth:
            name = self.stack.pop().name
            self.depths[name].pop()
            if name not in INLINE:
                self.blocks.pop()

    def nearest(self, names: Iterable[str]) -> int:
        """Depth of the nearest element of these names, 0 if none is open."""
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)


def parse(page: str) -> Node:
    """The tree of a page; whatever is wrong with the markup, its text is kept once."""
    root = Node("#page")
    open_ = _Open(root)
    at, end = 0, len(page)

    def text(piece: str) -> None:
        if piece:
            open_.stack[-1].children.append(piece)

    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            if m.group().startswith("<![CDATA["):
                text(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if m["close"]:
            depth = open_.nearest([name])
            if name == "p" and not depth:
                open_.stack[-1].children.append(Node("p"))
            # an inline element does not end the block around it
            elif depth and not (name in INLINE and depth < open_.blocks[-1]):
                open_.cut(depth)
            continue
        rest = m["rest"] or ""
        _close_before(name, open_)
        node = Node(name, " ".join(a or b or c for a, b, c in _NAMED.findall(rest)) if "=" in rest else "")
        open_.stack[-1].children.append(node)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)[^>]*>?", re.I).search(page, at)
            node.children.append(page[at : close.start() if close else end])
            at = close.end() if close else end
        elif name not in VOID and not rest.endswith("/"):
            open_.push(node)
    return root


def _close_before(name: str, open_: _Open) -> None:
    """Close what a start tag closes: the row before it, and a paragraph before a block."""
    if name in CLOSES:
        rows, around = CLOSES[name]
    elif name not in INLINE and name not in VOID and name not in RAW:
        rows, around = {"p"}, {"article", "section", "div", "body", "td", "th", "li", "blockquote", "button", "object"}
    else:
        return
    depth = open_.nearest(rows)
    if depth and depth >= open_.nearest(around):
        open_.cut(depth)


def _is_aside(node: Node, under_article: bool) -> bool:
    if node.name in ASIDE and not (node.name == "header" and under_article):
        return True
    return bool(node.marks) and node.name not in ("html", "body", "article", "main") and bool(BOILERPLATE.search(node.marks))


def _named_in_passing(node: Node) -> bool:
    """Whether only names like "related-work" say that a node is an aside: a word that also
    has other meanings, beside one that is not just about layout."""
    for name in node.marks.split():
        words = [w for w in re.split(r"[_-]+", name.lower()) if w]
        if any(BOILERPLATE.search(w) for w in words):
            telling = [w for w in words if not LAYOUT.fullmatch(w)]
            if any(BOILERPLATE.search(w) and w not in AMBIGUOUS for w in words) or all(BOILERPLATE.search(w) for w in telling):
                return False
    return True


def _pruned(root: Node) -> None:
    """Take out scripts, forms, menus and the like, at any depth.

    A form, or an element that only its names mark, stays where it is around the main
    text: the page's ``main``, else its longest article, or ``MAIN_SHARE`` of the unlinked
    characters that are in no other kind of aside. Inside an article, one whose names have
    other meanings too ("related-work") stays where its text is dense.
    """
    below = _unlinked(root)
    most = MAIN_SHARE * below[id(root)][0]
    mains = [n for _, n, *_ in below.values() if n.name == "main"] or [n for _, n, *_ in below.values() if n.name == "article"]
    main = max(mains, key=lambda n: below[id(n)][0], default=None)
    around = _around(root, main) if main else set()
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.name in ("article", "main")

        def stays(c: Node) -> bool:
            if not _is_aside(c, inside):
                return True
            if c.name in ASIDE and c.name not in WRAPPERS:
                return False
            if inside and c.name not in ASIDE and _named_in_passing(c) and _is_dense(below[id(c)]):
                return True
            # beside the main element nothing is main text, whatever its share
            return id(c) in around or ((main is None or inside) and below[id(c)][0] > 0 and below[id(c)][0] >= most)

        node.children = [c for c in node.children if isinstance(c, str) or stays(c)]
        todo += [(c, inside) for c in node.children if not isinstance(c, str)]


def _unlinked(root: Node) -> dict[int, tuple[int, Node, int, int]]:
    """Of every node outside the asides that are never main text: its unlinked characters,
    the node, all its characters and its tags."""
    order, todo = [], [(root, False)]
    while todo:
        node, linked = todo.pop()
        order.append((node, linked))
        todo += [(c, linked or c.name == "a") for c in node.children if not isinstance(c, str) and (c.name not in ASIDE or c.name in WRAPPERS)]
    found: dict[int, tuple[int, Node, int, int]] = {}
    for node, linked in reversed(order):
        chars = sum(len(_SPACE.sub("", html.unescape(c))) for c in node.children if isinstance(c, str))
        inner = [found[id(c)] for c in node.children if not isinstance(c, str) and id(c) in found]
        unlinked = (0 if linked else chars) + sum(x[0] for x in inner)
        found[id(node)] = unlinked, node, chars + sum(x[2] for x in inner), sum(x[3] + 1 for x in inner)
    return found


def _is_dense(counts: tuple) -> bool:
    unlinked, _, chars, tags = counts
    return unlinked >= (1 - LINKED_SHARE) * chars and unlinked >= LEAST_DENSITY * max(tags, 1)


def _around(root: Node, inner: Node) -> set[int]:
    """The ids of the nodes that a node lies in, itself among them."""
    parents, todo = {}, [root]
    while todo:
        node = todo.pop()
        for c in node.children:
            if not isinstance(c, str):
                parents[id(c)] = node
                todo.append(c)
    found = {id(inner)}
    while inner is not root:
        inner = parents[id(inner)]
        found.add(id(inner))
    return found


def _measure(root: Node) -> list[Node]:
    """Count characters, tags, link characters and link tags below each node; children come first."""
    order, todo = [], [(root, False)]
    linked: dict[int, bool] = {}
    while todo:
        node, link = todo.pop()
        linked[id(node)] = link or node.name == "a"
        order.append(node)
        todo += [(c, linked[id(node)]) for c in node.children if not isinstance(c, str)]
    order.reverse()
    for node in order:
        for c in node.children:
            if isinstance(c, str):
                n = len(_SPACE.sub("", html.unescape(c)))
                node.chars += n
                node.link_chars += n * linked[id(node)]
            else:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags + (c.name == "a")
    return order


def _densities(order: list[Node], body: Node) -> None:
    """Composite text density: characters per tag, less the more of them are links.

    The logarithm's base grows with the share of links in the node and in the body, so
    its value falls from above 1 towards 0 for menus.
    """
    ratio = body.link_chars / max(body.chars, 1)
    for node in order:
        # one where there is none, so that nothing is divided by 0 and the base is above 1
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
            node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(base)
        node.density_sum = sum(x.density for x in node.children if not isinstance(x, str))


def _find(node: Node, name: str) -> Node | None:
    todo = [node]
    while todo:
        here = todo.pop()
        if here.name == name:
            return here
        todo += [c for c in reversed(here.children) if not isinstance(c, str)]
    return None


def _main_nodes(body: Node, order: list[Node]) -> set[int]:
    """The ids of the nodes whose whole text is main text.

    The threshold is the smallest density on the path from the body to the node with the
    largest sum of densities; one without elements counts with its own density. From the
    body downwards, every node whose density reaches the threshold adds the node with the
    largest sum in it, unless it lies in one that is added already. A part of a text (a
    paragraph, a cell) is left for the block around it, and that for the article around it.
    """
    parents = {id(c): n for n in order for c in n.children if not isinstance(c, str)}
    best: dict[int, Node] = {}
    # on the path from a node's best up to it: the first that may be the whole of a text, and
    # the first article from there on
    block: dict[int, Node | None] = {}
    article: dict[int, Node | None] = {}
    for node in order:  # children come first
        if all(isinstance(c, str) for c in node.children):
            node.density_sum = node.density
        through, found = None, node
        for c in node.children:
            if not isinstance(c, str) and best[id(c)].density_sum > found.density_sum:
                through, found = c, best[id(c)]
        best[id(node)] = found
        first = block[id(through)] if through else None
        block[id(node)] = first or (node if node.name not in INLINE and node.name not in PARTS else None)
        first = article[id(through)] if through else None
        article[id(node)] = first or (node if node.name in ("article", "main") else None)
    path = [best[id(body)]]
    while path[-1] is not body:
        path.append(parents[id(path[-1])])
    threshold = min(n.density for n in path)
    kept: set[int] = set()
    todo = [body]
    while todo:
        node = todo.pop()
        if id(node) in kept or not node.chars or node.density < threshold:
            continue
        whole = article[id(node)] or block[id(node)] or node
        kept.add(id(whole))
        if whole is not node:
            todo += [c for c in node.children if not isinstance(c, str)]
    return kept


def _blocks(node: Node, kept: set[int]) -> list[str]:
    """Texts of the blocks in the kept nodes below a node, in page order: inline elements go on
    with a block, all others end it."""
    blocks, now = [], []

    def end() -> None:
        whole = _SPACE.sub(" ", html.unescape("".join(now))).strip()
        now.clear()
        if whole:
            blocks.append(whole)

    todo: list = [(node, False)]
    while todo:
        here, inside = todo.pop()
        if here is None:
            end()
            continue
        if isinstance(here, str):
            if inside:
                now.append(here)
            continue
        inside = inside or id(here) in kept
        if here.name not in INLINE:
            end()
            todo.append((None, inside))
        todo += [(c, inside) for c in reversed(here.children)]
    end()
    return blocks


def main_text(page: str | None) -> str:
    """The main text of a page: blocks joined by line ends, '' where there is none."""
    root = parse(page or "")
    body = _find(root, "body") or root
    _pruned(body)
    order = _measure(body)
    if not body.chars:
        return ""
    _densities(order, body)
    return "\n".join(_blocks(body, _main_nodes(body, order)))


def extract_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """The rows of ``pages`` with ``text``, the main text, in place of the html, and ``n_chars``.

    The tree of the whole page is built, without scripts, forms, menus and the like. Every
    node gets its composite text density, and the node with the largest sum of its
    children's densities is taken, with all other parts of the page that are no less dense
    than the path from the body to it, in page order. A null or empty page gives ''. Broken markup never
    fails: it is read as browsers do, as far as blocks go, in a time linear in its length but
    for tables of names. Repeated pages each give a row; an empty table gives none. Other
    columns stay as they are, except those of the two names.
    """
    kept = [c for c in pages.columns if c not in (source, "text", "n_chars")]
    name = fresh(pages.columns, "html")
    given = pages.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{source}`").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch[name]]
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *columns], [*kept, "text", "n_chars"])

    return given.mapInArrow(run, given.drop(name).schema.add("text", "string").add("n_chars", "long"))

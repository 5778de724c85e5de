"""Main text of web pages by composite text density (operator 6).

For every block node of the page's tree (inline elements belong to their block):

- ``chars``, ``tags``, ``link chars``, ``link tags`` of its subtree;
- density: characters per tag, adjusted for links,
  ``C/T * log(C/LC * T/LT, base 1 + ln(C/(C-LC) * LC + LCb/Cb * C + e))`` (zeros count as one;
  ``b``: the body);
- density sum: the sum of its children's densities.

The node with the largest density sum holds the article. The threshold is the least density on
the path from the body to it, and subtrees beside the path that reach the threshold are taken
too, as are texts that stand directly in the nodes of the path; the names ``article`` and ``main``
play no part in the choice.

Elements that declare themselves as something else never take part if their name says so
(navigation, footers, scripts) and their end tag is there. Those that declare it by a whole class
name (adverts, notices, reader comments) and forms are left
out if together they hold a minor share of the page's text; else they stay with lowered density.
A word inside a longer class name, or a missing end tag, only lowers the density; in the article's
subtree, blocks of the first kind that do not reach the threshold are left out if they hold a minor
share together, of the second if they are mostly links. A share is minor below half of the text, or
below 250 characters if undeclared elements have text.

Defined results: a null or empty page, or one without text, gives "" (0 characters);
unclosed, crossed and unknown tags are read as browsers do, approximately: a block start ends
an open paragraph, an end tag ends all that is open inside its element.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z]+")
_HEAD_END = re.compile(r"</head\s*>|(?=<body[\s>])", re.I)

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul"
    .split())
NOT_TEXT = frozenset(
    "script style noscript template head title nav footer aside form iframe object embed svg math canvas audio video button "
    "select textarea input dialog menu search map".split())
# Elements that end an open element of the same kind, up to the containers behind them.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
            "option": ({"option"}, {"select"})}
# Words of class, id and role that declare an element as not part of the article.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "alert popup modal overlay newsletter subscribe subscription share sharing social sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager footer header masthead comment comments disqus reply replies related "
    "recommended recommendations widget complementary contentinfo search login signup toolbar".split())
OPTIONAL_END = frozenset("p li dt dd tr td th thead tbody tfoot".split())
NEVER_BOILERPLATE = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())


# What an element declares: nothing; by a word inside a longer class name; anything, but without its
# end tag; by a whole class name or by <form>; by its name or as hidden.
PLAIN, WEAK, OPEN, STRONG, OTHER = range(5)
LOWERED = 0.5  # density of declared elements that stay
SHORT = 250  # characters that make no article where there is other text


class _Run:
    """Text directly inside a block, with its inline elements."""

    __slots__ = ("parts", "elements", "text", "chars", "link_chars", "tags", "link_tags")

    def __init__(self):
        self.parts: list[tuple[str, bool, bool]] = []  # (text, in a link, in a declared inline element)
        self.elements: list[tuple[bool, bool]] = []  # (is a link, in a declared inline element)

    def measure(self, without_declared: bool) -> None:
        parts = [p for p in self.parts if not (without_declared and p[2])]
        self.text = " ".join("".join([p[0] for p in parts]).split())
        self.chars = len(self.text)
        self.link_chars = sum(_solid(p[0]) for p in parts if p[1])
        links = [link for link, declared in self.elements if not (without_declared and declared)]
        self.tags, self.link_tags = len(links), sum(links)


class _Block:
    __slots__ = ("tag", "parent", "kind", "items", "tags", "link_tags", "chars", "link_chars", "weight", "density", "total")

    def __init__(self, tag: str, parent: _Block | None, kind: int = PLAIN):
        self.tag, self.parent, self.kind = tag, parent, kind
        self.items: list[_Run | _Block] = []  # in page order

    def run(self) -> _Run:
        if not self.items or isinstance(self.items[-1], _Block):
            self.items.append(_Run())
        return self.items[-1]

    def blocks(self) -> list[_Block]:
        return [x for x in self.items if isinstance(x, _Block)]


def _solid(text: str) -> int:
    """Characters that are not space."""
    return len("".join(text.split()))


def _declared(tag: str, attrs: str, in_article: bool) -> int:
    if tag in NOT_TEXT or (tag == "header" and not in_article):
        return STRONG if tag == "form" else OTHER
    if not attrs or tag in NEVER_BOILERPLATE or tag not in BLOCK and tag not in ("span", "a"):
        return PLAIN
    kind = PLAIN
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and "true" in value:
            return OTHER
        if name in ("class", "id", "role"):
            value = unescape(value).lower()
            if not BOILERPLATE.isdisjoint(value.strip("\"'").split()):
                kind = STRONG
            elif kind == PLAIN and not BOILERPLATE.isdisjoint(_WORDS.findall(value)):
                kind = WEAK
    return kind


def parse(html: str) -> _Block:
    """The block tree of a page; elements that are not text by name, and end where they say, are
    left out."""
    root = _Block("#root", None)
    block = root
    open_tags: list[tuple[str, _Block | None, bool]] = []  # (tag, its block, or None if inline; declared inline)
    # Where each name, and any block, is open in ``open_tags``, outermost first: no tag walks the stack.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    links = articles = declared = 0
    at, size = 0, len(html)
    head_ends = True

    def innermost(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(down_to: int, ended: bool = False) -> None:
        """Close all from ``down_to`` on; ``ended``: the outermost has its end tag."""
        nonlocal block, links, articles, declared
        while len(open_tags) > down_to:
            tag, own, inline = open_tags.pop()
            places[tag].pop()
            if own is not None:
                blocks.pop()
                block = own.parent
                if own.kind >= STRONG and tag not in OPTIONAL_END and not (ended and len(open_tags) == down_to):
                    own.kind = OPEN  # what should follow it is inside
                elif own.kind == OTHER:
                    block.items.pop()  # the last, as it was open
            links -= tag == "a"
            declared -= inline
            articles -= tag in ("article", "main")

    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            part = html[at:lt]
            block.run().parts.append((unescape(part) if "&" in part else part, links > 0, declared > 0))
        if lt == size:
            break
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), lt):
            end = html.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(html, lt)
        if not m:
            if re.match(r"</?[a-zA-Z]", html[lt : lt + 3]):  # a tag that the page's end cuts off
                break
            block.run().parts.append(("<", links > 0, declared > 0))
            at = lt + 1
            continue
        at = m.end()
        slash, tag, attrs = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        tag = tag.lower()
        is_block = tag in BLOCK
        if slash:
            i = innermost((tag,))
            if i >= 0 and (is_block or not blocks or i >= blocks[-1]):  # an inline end tag ends no block
                close(i, True)
            continue
        if is_block and blocks and open_tags[blocks[-1]][0] == "p":  # a block start ends an open paragraph
            close(blocks[-1], True)
        if tag in SIBLINGS:
            same, until = SIBLINGS[tag]
            i = innermost(same)
            if i >= 0 and i > innermost(until):
                close(i, True)
        if tag in VOID:
            if tag in ("br", "hr"):
                block.run().parts.append((" ", False, False))
            elif tag != "wbr":
                block.run().elements.append((False, declared > 0))
            continue
        kind = _declared(tag, attrs, articles > 0)
        if kind >= STRONG and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if kind >= STRONG and attrs.endswith("/"):
            continue
        if tag == "head":  # ends at its end tag, or where the body begins
            end = _HEAD_END.search(html, at) if head_ends else None
            head_ends = end is not None
            at = end.end() if end else at
            continue
        if is_block or kind == OTHER:
            if tag in ("html", "body") and places.get(tag):
                continue
            child = _Block(tag, block, max(kind, STRONG) if declared else kind)
            block.items.append(child)
            block = child
            blocks.append(len(open_tags))
            places.setdefault(tag, []).append(len(open_tags))
            open_tags.append((tag, child, False))
        else:
            declared += kind == STRONG
            block.run().elements.append((tag == "a", declared > 0))
            places.setdefault(tag, []).append(len(open_tags))
            open_tags.append((tag, None, kind == STRONG))
        links += tag == "a"
        articles += tag in ("article", "main")
    close(0)
    return root


def _weigh(root: _Block) -> bool:
    """Sets the weights of all blocks; whether strongly declared elements are left out: if together
    they hold a minor share of the page's text. Else they stay, with lowered density."""
    held, nodes, todo = [0] * (OTHER + 1), [], [(root, PLAIN)]
    while todo:
        node, kind = todo.pop()
        kind = max(kind, node.kind)
        nodes.append(node)
        for item in node.items:
            if isinstance(item, _Block):
                todo.append((item, kind))
            else:
                for text, _, declared in item.parts:
                    held[STRONG if declared else kind] += _solid(text)
    minor = lambda n: 2 * n < sum(held) or n < SHORT and held[PLAIN] > 0
    drop = minor(held[STRONG])
    lowered = {OPEN, STRONG, WEAK} if minor(held[WEAK]) else {OPEN, STRONG}
    for node in nodes:  # parents first
        node.weight = LOWERED if node.kind in lowered else node.parent.weight if node.parent else 1
        if node.kind == WEAK and WEAK not in lowered or node.kind == STRONG and not drop:
            node.kind = PLAIN  # part of the article, if it lies in its subtree
        if drop:
            node.items = [x for x in node.items if not (isinstance(x, _Block) and x.kind == STRONG)]
    return drop


def _density(c: int, lc: int, t: int, lt: int, share: float) -> float:
    lc, t, lt = min(lc, c), max(t, 1), max(lt, 1)
    base = 1 + math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / t * math.log(max(c / max(lc, 1) * t / lt, 1), base)


def _measure(root: _Block) -> list[_Block]:
    """All blocks, parents first, with counts, densities and density sums."""
    drop = _weigh(root)
    order, i = [root], 0
    while i < len(order):
        order.extend(order[i].blocks())
        i += 1
    for node in reversed(order):
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for item in node.items:
            if isinstance(item, _Block):
                node.tags += 1
            else:
                item.measure(drop)
            node.chars += item.chars
            node.link_chars += item.link_chars
            node.tags += item.tags
            node.link_tags += item.link_tags
    share = root.link_chars / max(root.chars, 1)
    for node in order:
        node.density = node.weight * _density(node.chars, node.link_chars, node.tags, node.link_tags, share)
    for node in order:
        node.total = sum(x.density for x in node.blocks())
    return order


def _belongs(node: _Block) -> bool:
    """Whether a block in the article's subtree, below the threshold, is of the article."""
    return node.kind == PLAIN or node.kind == OPEN and 2 * node.link_chars < node.chars


def main_text(html: str | None) -> str:
    """The article's blocks in page order, joined by one space."""
    if not html:
        return ""
    order = _measure(parse(html))
    root = order[0]
    if not root.chars:
        return ""
    best = max(order, key=lambda n: n.total)  # the first of equals: the outer one
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    top = [n for n in path if n.tag not in ("#root", "html")] or path
    least = min(n.density for n in top)
    share = root.link_chars / root.chars
    on_path = set(map(id, path)) - {id(best)}
    out, todo = [], [(root, False)]
    while todo:
        item, inside = todo.pop()  # inside: of a subtree that is taken
        if isinstance(item, _Run):
            if item.chars and (inside or _density(item.chars, item.link_chars, item.tags, item.link_tags, share) >= least):
                out.append(item.text)
        elif id(item) in on_path:
            todo.extend((x, False) for x in reversed(item.items))
        elif item is best or item.density >= least or inside and _belongs(item):
            todo.extend((x, True) for x in reversed(item.items))
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """All columns but ``html`` (and any named ``out`` or ``n_chars``), then the main text and
    its length in code points. Narrow: no shuffle."""
    import pyarrow as pa
    from pyspark.sql import types as T

    keep = [f for f in pages.schema.fields if f.name not in (html, out, "n_chars")]
    schema = T.StructType([*keep, T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[f.name for f in schema.fields])

    return pages.select(*[pages[f.name] for f in keep], pages[html]).mapInArrow(run, schema)

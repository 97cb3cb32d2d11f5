"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML, and usual names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object textarea title svg annotation".split())
FURNITURE = frozenset(
    "head nav footer aside form menu dialog button select option input label fieldset canvas "
    "audio video applet map search".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar tablist status".split()
)
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar "
    "aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments respond disqus replies reply discussion pagination pager "
    "toolbar skip".split()
)
REMARKS = frozenset("comment comments respond disqus replies reply discussion".split())
# Words that say nothing more beside a name of furniture: a comment list is comments.
NEUTRAL = frozenset(
    "list lists item items box boxes block section area container wrapper wrap inner outer bar "
    "panel link links icon icons button buttons group top bottom left right site global sticky "
    "fixed thread threads count stories posts articles recent latest popular more".split()
)
# Names that a section of an article can have as a slug of its heading.
TOPICS = frozenset(
    "discussion notice notices alert related share reply replies header banner menu aside rail "
    "recommended overlay skip footer navigation promotion advertising topbar".split()
)
KEPT = frozenset("html body article main".split())
ARTICLE = frozenset("article main".split())
# Headings and paragraphs often have slugs as ids; in an article, sections as well.
SLUGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p".split())
#: An element with a name of furniture is furniture unless it holds so large a share of the page's
#: text, less than half of it in links; reader comments, unless there is hardly any other text.
HOLDS_PAGE, HOLDS_ALL = 0.6, 0.98
# A start tag ends these open elements, up to the nearest of the elements that bound them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
ENDS_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "legend"}
# An element that ends a paragraph has ended those around it, so the search for one stops there.
P_BOUNDS = BLOCK - {"p"} | {"button", "object"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")


class Node:
    __slots__ = (
        "tag", "parent", "inside", "named", "parts", "chars", "link", "tags", "links", "density", "total"
    )

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.inside = tag in ARTICLE or parent is not None and parent.inside
        self.named = 0  # by class or id: 1 a word of furniture, 2 furniture, 3 reader comments
        self.parts: list[Node | str] = []
        self.chars = self.link = self.tags = self.links = 0
        self.density = self.total = 0.0


def _is_furniture(node: Node, attributes: str) -> bool:
    """Whether an element is page furniture by its tag, its role, or because it is not shown.

    Names in a class or id only set ``named``; ``prune`` decides about them when all is measured.
    """
    tag, within = node.tag, node.parent.inside
    if tag in FURNITURE:
        return True
    if tag == "header" and not within:
        return True
    if not attributes or tag in KEPT:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id"):
            node.named = max([node.named, *(_kind_of(n, node) for n in value.split())])
    return False


def _kind_of(name: str, node: Node) -> int:
    """What one name of a class or id says: 0 nothing, 1 that a word of it is one of furniture,
    2 that all of it is, 3 that it is reader comments.

    Paragraphs and headings, and sections of an article, have slugs of topics as names; for them
    it takes a whole name that is no topic.
    """
    words = [w.lower() for w in _NAME.findall(name)]
    if NAMES.isdisjoint(words):
        return 0
    if not NAMES.union(NEUTRAL).issuperset(words):
        return 1
    one, topic = len(words) == 1, not TOPICS.isdisjoint(words)
    if node.tag in SLUGS and (topic or not one):
        return 1
    if node.tag == "section" and node.parent.inside and topic and one:
        return 1
    return 3 if not REMARKS.isdisjoint(words) else 2


def parse(html: str) -> Node:
    """The tree of a page without scripts, styles, markup comments and furniture by tag or role.

    End tags that HTML lets out are supplied; an end tag without its start is skipped. Furniture
    is read over up to its end tag, or up to the end of the element around it.
    """
    root = Node("html", None)
    stack, at = [root], 0
    open_: Counter = Counter()
    skipped = 0  # depth in the stack of the furniture that is read over

    def text(upto: int) -> None:
        if upto > at and not skipped:
            stack[-1].parts.append(unescape(html[at:upto]))

    def close(names: set[str], bounds: set[str]) -> None:
        nonlocal skipped
        if not any(open_[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in bounds:
                return
            if stack[k].tag in names:
                open_.subtract(n.tag for n in stack[k:])
                del stack[k:]
                if skipped >= len(stack):
                    skipped = 0
                return

    position = 0
    while found := _TOKEN.search(html, position):
        start, position = found.span()
        text(start)
        at = position
        if not (tag := found[2]):
            continue
        tag = tag.lower()
        if found[1]:
            close({tag}, {"table"} if tag in ("p", "div", "span", "b", "i", "a", "li") else set())
            if tag == "br" and not skipped:
                stack[-1].parts.append(" ")
            continue
        attributes = found[3]
        if tag in RAW:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(html, position)
                position = at = end.end()
            continue
        if tag in ("html", "body") and open_[tag]:
            continue
        if tag in ENDS_P:
            close({"p"}, P_BOUNDS)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            close({stack[-1].tag}, set())
        if tag in VOID:
            if not skipped and tag in ("br", "hr", "img"):
                stack[-1].parts.append(Node(tag, stack[-1]) if tag == "hr" else " " if tag == "br" else "")
            continue
        node = Node(tag, stack[-1])
        if not skipped:
            if _is_furniture(node, attributes):
                skipped = len(stack)
            else:
                stack[-1].parts.append(node)
        if not attributes.endswith("/") or tag not in ("path", "use"):
            stack.append(node)
            open_[tag] += 1
    text(len(html))
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def measure(root: Node) -> list[Node]:
    """Composite text density of every node, and the sum of its children's.

    Density is characters per tag, times the logarithm of characters over link characters times
    tags over link tags. The base of the logarithm grows with the share of links in the node and
    in the page (Sun, Song and Liao, 2011). Counts of zero stand as one.
    """
    nodes = _nodes(root)
    for node in reversed(nodes):
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        children = [p for p in node.parts if isinstance(p, Node)]
        node.chars = own + sum(c.chars for c in children)
        node.tags = sum(c.tags + 1 for c in children)
        if node.tag == "a":
            node.link, node.links = node.chars, 1
        else:
            node.link = sum(c.link for c in children)
            node.links = sum(c.links for c in children)
    body_links = root.link / max(root.chars, 1)
    for node in nodes:
        c, link, tags, links = node.chars, node.link, max(node.tags, 1), max(node.links, 1)
        if c:
            other = max(c - link, 1)
            base = math.log(c / other * link + body_links * c + math.e)
            ratio = c / max(link, 1) * (tags / links)
            node.density = c / tags * max(math.log(max(ratio, 1.0)), 0.0) / math.log(max(base, 1.01) + 1)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
    return nodes


def prune(root: Node) -> None:
    """Take out elements that are furniture by name.

    A name is no proof where an element holds most of the page's text, few links, and an article
    or main element, if the page has one with text at all.
    """
    nodes = measure(root)
    whole = max(root.chars, 1)
    articles = [n for n in nodes if n.tag in ARTICLE and n.chars]
    for node in nodes:
        if node.named < 2:
            continue
        share = node.chars / whole
        most = share >= (HOLDS_ALL if node.named == 3 else HOLDS_PAGE) and node.link * 2 < node.chars
        if not most or articles and not any(_within(n, node) for n in articles):
            node.parent.parts = [p for p in node.parent.parts if p is not node]


def _within(node: Node | None, around: Node) -> bool:
    while node is not None and node is not around:
        node = node.parent
    return node is around


def choose(root: Node) -> list[Node]:
    """The subtrees that hold the article.

    The node with the largest density sum is taken, or the nearest article or main element around
    it. The least density on the way from it to the body is the threshold: elements of the same name
    beside it that reach it are parts of the article as well.
    """
    nodes = measure(root)
    top = max(nodes, key=lambda n: n.total)
    if not top.total:
        top = root
    path = [top]
    while path[-1].parent:
        path.append(path[-1].parent)
    around = [n for n in path if n.tag in ARTICLE]
    if around:
        top = around[0]
        path = path[path.index(top) :]
    threshold = min((n.density for n in path[:-1]), default=0.0)
    parent = top.parent
    if not parent or around:
        return [top]
    return [
        p
        for p in parent.parts
        if p is top
        or isinstance(p, Node)
        and p.tag == top.tag
        and p.total
        and p.density >= threshold
        and p.link * 2 < p.chars
    ]


def _is_menu(node: Node) -> bool:
    """Inside an article only elements whose name speaks of furniture can be menus."""
    if node.inside and not node.named:
        return False
    return node.tag in ("ul", "ol", "dl", "div", "section", "table", "p") and (
        node.links >= 3 and node.link * 10 >= node.chars * 8
    )


def blocks(root: Node) -> list[str]:
    """The texts of the blocks below a node: white space as one space, trimmed, none empty."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        words = " ".join("".join(run).split())
        run.clear()
        if words:
            out.append(words)

    todo: list[Node | str | None] = [root]
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            run.append(part)
        elif part is root or not _is_menu(part):
            if part.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(part.parts))
    flush()
    return out


def main_text(html: str) -> str:
    root = parse(html)
    prune(root)
    return "\n".join(b for node in choose(root) for b in blocks(node))


def extract(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """The main text of every page: the ``keep`` columns, ``text`` and ``n_chars``.

    A null or empty page, and one without text, has an empty text. Every page is read whole; long
    and broken pages are no special case. Rows keep their order and number, nothing is shuffled.
    """
    plain = pages.select(*keep, F.coalesce(html_col, F.lit("")).alias("_html"))
    names = [f"c{k}" for k in range(len(keep))]
    plain = plain.toDF(*names, "html")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)],
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                [*names, "text", "n_chars"],
            )

    return plain.mapInArrow(scan, f"{kinds}, text string, n_chars long").toDF(*keep, "text", "n_chars")

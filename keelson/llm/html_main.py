"""Main text of web pages by composite text density.

A page is read into a tree of its block elements.  Every node has C characters and T tags below it, LC and LT of
them in links, and the density  C / T * log(C / LC * T / LT) / log(log(C * LC / (C - LC) + C * LCb / Cb + e)),
characters per tag made smaller by links (b: the body; zeros count as one).  The sum of its children's densities
tells a container of dense blocks from a block.  The node of the whole page with the largest sum is the content, the
least density on its path up to the body is the threshold, and in every node of that density or more the node with the
largest sum is content too.

What lies next to the content in the tree joins it, so that headings and short lines are not lost.  Content in an
``article``, or else a ``main``, is joined by all of that element; one that holds no content found is left out.  Other
content is joined by what lies between its blocks and, outwards on both sides, by headings, paragraphs, items and cells
that are not mostly links, up to the next menu, page header, footer, form or article.

Left out are elements that are furniture by their meaning (menus, page headers, footers, sidebars, notices, adverts,
forms, scripts, styles, reader comments): by tag, by role, or by a class or id made of furniture words alone, unless
it holds the ``main`` or all articles of the page.  A class or id with other words beside (``related-work``) is a weak
sign, and counts only where a third of the text is links.  A menu without a name is a run of three links or more that
is nothing but links and less dense than the threshold.

Blocks of text are trimmed, their white space becomes single blanks, and they are joined by line feeds in page order.
Null and empty pages have an empty text; unclosed and stray tags are read as browsers read them (a slash closes only
empty elements, a tag that never ends takes the rest of the page), an unclosed script or style runs to the end; pages of
any size and nesting are read whole, in time that grows with their length; repeated rows give equal texts; an empty
table an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.rows import free_name, sliced

# What HTML's elements are, and which names furniture goes by.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_FURNITURE_TAGS = frozenset("nav footer aside form button select menu dialog template svg object canvas head".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices "
    "popup modal newsletter subscribe subscription sidebar sidebars widget widgets comment comments disqus reply replies related "
    "share sharing social menu navbar navigation breadcrumb breadcrumbs pagination pager footer masthead login signup".split()
)
_LAYOUT_WORDS = frozenset("area bar block bottom box button buttons center col column container content form group header inner item items left link links list main page panel right row section site slot thread top unit wrap wrapper".split())
_TEXT_TAGS = frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup li p pre td th".split())
_BARRIERS = frozenset("nav header footer form".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "p": ("table", "td", "th", "button", "object")}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


#: A name with other words beside furniture words is furniture from this share of links up.
WEAK_NAME_LINKS = 1 / 3
#: A run of at least so many links that is this share links, in characters, can be a menu; a joined line is less than half links.
MENU_LINKS, MENU_SHARE = 3, 0.9


class Node:
    __slots__ = ("articles", "blocks", "chars", "children", "density", "furniture", "link_chars", "link_tags", "mains", "own_chars", "own_links", "parent", "sign", "tag", "tags", "text", "unit")

    def __init__(self, tag: str, parent: Node | None, sign: int) -> None:
        self.tag, self.parent, self.sign = tag, parent, sign
        self.children: list[Node] = []
        self.blocks: list[tuple[int, str]] = []  # place in the page and text of the blocks right below
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.own_chars = self.own_links = self.articles = self.mains = 0
        self.density = 0.0
        self.furniture = False
        self.unit: Node | None = parent.unit if parent else None  # the outermost article, or else main, around it
        if tag == "article" and (self.unit is None or self.unit.tag == "main") or tag == "main" and self.unit is None:
            self.unit = self
        self.text: bool = tag in _TEXT_TAGS or (parent is not None and parent.text)


_NONE, _WEAK, _NAMED, _MEANT = range(4)


def _sign(tag: str, attributes: str, in_unit: bool) -> int:
    """How much an element looks like furniture: not at all, by a part of a name, by a whole name, by tag or role."""
    if tag in _FURNITURE_TAGS or (tag == "header" and not in_unit):
        return _MEANT
    if tag in ("body", "html", "main") or "=" not in attributes:
        return _NONE
    sign = _NONE
    for name, *values in _ATTRIBUTE.findall(attributes):
        for value in "".join(values).lower().split():
            if name.lower() == "role":
                sign = max(sign, _MEANT if value in _FURNITURE_ROLES else _NONE)
                continue
            words = [w for w in re.split(r"[^a-z]+", value) if w]
            if not _FURNITURE_WORDS.isdisjoint(words):
                whole = all(w in _FURNITURE_WORDS or w in _LAYOUT_WORDS for w in words)
                sign = max(sign, _NAMED if whole else _WEAK)
    return sign


def parse(page: str) -> list[Node]:
    """The block elements of a page in page order, the root first, each with its own blocks of text."""
    root = Node("html", None, _NONE)
    nodes, here, at, n_blocks = [root], root, 0, 0
    path = [root]  # the open elements
    places: dict[str, list[int]] = {}  # by tag, where its open elements stand in the path
    run: list[str] = []
    links = link_chars = link_tags = 0

    def flush() -> None:
        nonlocal n_blocks, link_chars, link_tags
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            here.blocks.append((n_blocks, text))
            n_blocks += 1
            here.chars += len(text)
        here.link_chars += min(link_chars, len(text))
        here.link_tags += link_tags
        link_chars = link_tags = 0

    def close_to(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Close the innermost open element with one of the tags, unless one of the scope lies further in."""
        nonlocal here
        place = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if place and place > max((places[t][-1] for t in scope if t not in tags and places.get(t)), default=0):
            while len(path) > place:
                places[path.pop().tag].pop()
            here = path[-1]

    def add_text(piece: str) -> None:
        nonlocal link_chars
        if piece:
            text = html.unescape(piece) if "&" in piece else piece
            run.append(text)
            if links:
                link_chars += len(text.strip())

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            add_text(page[at:])
            break
        m = _TOKEN.match(page, begin)
        if not m:
            if re.match(r"</?[a-zA-Z]|<[!?]", page[begin : begin + 3]):  # a tag or declaration that never ends
                add_text(page[at:begin])
                break
            add_text(page[at : begin + 1])
            at = begin + 1
            continue
        add_text(page[at:begin])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1], m[3] or ""
        if tag in _RAW:
            if not closing:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                if tag not in _INLINE:
                    flush()
            continue
        if tag in _INLINE:
            if tag == "br":
                run.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
                link_tags += not closing
            continue
        flush()
        if closing:
            links = 0
            close_to((tag,), _SCOPES.get(tag, ()))
            continue
        if tag in _CLOSES_P:
            close_to(("p",), _SCOPES["p"])
        if tag in _SIBLINGS:
            close_to(_SIBLINGS[tag], _SCOPES[tag])
        if tag in ("html", "body") and any(x.tag == tag for x in nodes[:4]) and (tag == "body" or here is root):
            continue
        node = Node(tag, here, _sign(tag, attributes, here.unit is not None))
        here.children.append(node)
        nodes.append(node)
        if tag not in _VOID:
            places.setdefault(tag, []).append(len(path))
            path.append(node)
            here = node
    flush()
    return nodes


def mark_furniture(nodes: list[Node]) -> None:
    """Tell furniture by its signs; a weak one counts where links are many in all that lies below."""
    chars = {id(x): x.chars for x in nodes}
    links = {id(x): x.link_chars for x in nodes}
    for node in reversed(nodes):
        node.own_chars, node.own_links = node.chars, node.link_chars
        node.articles += node.tag == "article" and node.sign < _NAMED
        node.mains += node.tag == "main"
        if node.parent is not None:
            chars[id(node.parent)] += chars[id(node)]
            links[id(node.parent)] += links[id(node)]
            node.parent.articles += node.articles
            node.parent.mains += node.mains
    for node in nodes:
        holds = node.mains > 0 or 0 < node.articles == nodes[0].articles
        node.furniture = (
            (node.parent is not None and node.parent.furniture)
            or node.sign == _MEANT
            or (node.sign == _NAMED and not holds)
            or (node.sign == _WEAK and links[id(node)] > WEAK_NAME_LINKS * chars[id(node)])
        )


def densities(nodes: list[Node]) -> None:
    """Sums over each subtree and each node's composite density; furniture counts towards the body's links only."""
    all_chars = sum(x.chars for x in nodes)
    all_links = sum(x.link_chars for x in nodes)
    for node in reversed(nodes):
        if not node.furniture:
            for child in node.children:
                if not child.furniture:
                    node.chars += child.chars
                    node.tags += child.tags + 1
                    node.link_chars += child.link_chars
                    node.link_tags += child.link_tags
    share = all_links / max(1, all_chars)
    for node in nodes:
        c, lc = node.chars, node.link_chars
        if not c or node.furniture:
            continue
        tags, link_tags = max(1, node.tags + node.link_tags), max(1, node.link_tags)
        base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e))
        node.density = c / tags * math.log(max(1.0, c / max(1, lc) * tags / link_tags) + 1) / max(base, 0.05)


def content_nodes(real: list[Node]) -> tuple[list[Node], float]:
    """The nodes that density finds to be content, and the threshold."""
    sums = {id(x): sum(y.density for y in x.children if not y.furniture) or x.density * 1e-9 for x in real}
    best = max(reversed(real), key=lambda x: sums[id(x)])  # of equals the innermost
    threshold, node = best.density, best
    while node.parent is not None and node.parent.tag not in ("html", "body"):
        node = node.parent
        threshold = min(threshold, node.density)
    densest: dict[int, Node] = {}  # the node with the largest sum in each subtree
    for x in reversed(real):
        densest[id(x)] = max([*(densest[id(y)] for y in x.children if id(y) in densest), x], key=lambda y: sums[id(y)])
    content = {id(x): x for x in (best, *(densest[id(y)] for y in real if y.density >= threshold))}
    return list(content.values()), threshold


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    nodes = parse(page)
    mark_furniture(nodes)
    densities(nodes)
    real = [x for x in nodes if not x.furniture and x.chars]
    if not real:
        return ""
    content, threshold = content_nodes(real)
    chosen = {id(x.unit or x) for x in content}
    inside: set[int] = set()  # nodes in what was chosen
    menus: set[int] = set()
    for node in nodes:  # parents first
        up = id(node.parent)
        if node.link_tags >= MENU_LINKS and node.link_chars >= MENU_SHARE * node.chars and node.density < threshold or up in menus:
            menus.add(id(node))
        if id(node) in chosen or up in inside:
            inside.add(id(node))

    taken: dict[int, str] = {}
    rest: dict[int, tuple[Node, str]] = {}
    loose: list[int] = []  # blocks of content outside articles and mains
    for node in nodes:
        for place, text in node.blocks:
            if id(node) in inside and not node.furniture and id(node) not in menus:
                taken[place] = text
                if node.unit is None:
                    loose.append(place)
            else:
                rest[place] = (node, text)
    if loose:
        _join_neighbours(taken, rest, menus, min(loose), max(loose))
    return "\n".join(taken[i] for i in sorted(taken))


def _join_neighbours(taken: dict[int, str], rest: dict[int, tuple[Node, str]], menus: set[int], first: int, last: int) -> None:
    """Add to the blocks taken those between ``first`` and ``last``, and their neighbours outwards up to a barrier."""

    def foreign(node: Node) -> bool:
        return node.furniture or id(node) in menus or node.unit is not None

    def barrier(node: Node) -> bool:
        if not node.furniture:
            return foreign(node)
        while node.parent is not None and node.parent.furniture:  # the element that makes it furniture
            if node.tag in _BARRIERS:
                return True
            node = node.parent
        return node.tag in _BARRIERS

    for place in range(first, last):
        if place in rest and not foreign(rest[place][0]):
            taken[place] = rest[place][1]
    for step, place in ((-1, first - 1), (1, last + 1)):
        while place in taken or place in rest:
            if place in rest:
                node, text = rest[place]
                if barrier(node):
                    break
                if not foreign(node) and node.text and 2 * node.own_links < node.own_chars:
                    taken[place] = text
            place += step


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with their main text in place of the html (underscores before ``name`` if there is such a column)."""
    kept = pages.drop(html_col)
    names, text = kept.columns, free_name(name, kept)
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, html_col):
            texts = pa.array([main_text(page.as_py()) for page in batch.column(html_col)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts], names=[*names, text])

    return pages.select(*(F.col(f"`{c}`") for c in names), html_col).mapInArrow(run, schema)

"""Main text of HTML pages by composite text density.

A page's tags become a tree. Scripts, form fields, media and hidden elements are cut off first. Elements that by their
tag, role or class are menus, forms, notices, reader comments and so on are cut off too, but only while the rest of the
page keeps the main text: one that holds several times the text of all the rest is a wrapper of the article with an
unlucky name, and stays, and what is inside it is judged by itself. Every node left has a density: characters per tag,
lowered by the share of characters and tags in links. A node's density sum adds its children's densities. The node with
the largest sum is the core; the smallest density on the path from it to the body is the page's threshold. From the body
down, a node of at least that density contributes its subtree of the largest density sum. The main heading beside or
above the core belongs to it.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Every alternative takes what it began with to its end or the page's, without going back, so a page is read in
#: time proportional to its length however broken it is.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
                    r"<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
                    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?P<end>>|\Z)|"
                    r"(?P<text>[^<]++|<)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_NAME = re.compile(r"[a-z0-9]+")

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open element of the given kinds, looked for up to an enclosing container.
CLOSES = {t: frozenset({"p"}) for t in
          "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
          "header hr main menu nav ol p pre section table ul".split()}
CLOSES |= {"li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
           "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}),
           "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"})}
CONTAINERS = frozenset("html body div article section main aside header footer nav table ul ol dl form blockquote "
                       "figure details fieldset".split())
#: Elements that never hold article text.
NO_TEXT_TAGS = frozenset(
    "head script style noscript template button select option textarea input iframe object embed svg canvas audio video "
    "map title xmp noframes".split())
#: Elements around a page's article that are cut off while the rest keeps the main text.
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar "
    "tablist".split())
#: Words in a class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar masthead footer foot "
    "sidebar sidebars sidenav aside cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login search searchform form share sharing social related "
    "recommended comment comments commentlist respond replies disqus widget widgets copyright skip hidden".split())
#: Tags and words that are never around an article: readers' comments, say, may well be longer than it is.
NEVER_WRAPPERS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer foot cookie cookies consent gdpr "
    "comment comments commentlist respond replies disqus copyright".split())
#: Such words only outside an article, and not beside a word for an article's own parts.
PAGE_NAMES = frozenset("header head top bottom".split())
ARTICLE_NAMES = frozenset("article post entry story content".split())
#: A possible wrapper stays if it has more than so many times the text of the rest of the page.
WRAPPER_RATIO = 5
KEEP, WRAPPER, GONE = range(3)
#: Elements that hold a paragraph or heading of their own.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_KEPT = frozenset("html body main article".split())
_NEGATION = frozenset("no has with without".split())


class Node:
    __slots__ = ("tag", "attrs", "items", "chars", "tags", "link_chars", "link_tags", "density", "total", "parent")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []  # children and texts, in order


def parse(page: str) -> Node:
    """The page's tree; end tags left out or out of place are mended, nothing is fetched or run."""
    root = Node("html", "", None)
    at, pos = root, 0
    while pos < len(page):
        m = _TOKEN.match(page, pos)
        pos = m.end()
        if (text := m["text"]) is not None:
            at.items.append(html.unescape(text) if "&" in text else text)
            continue
        if m["cdata"] is not None:
            at.items.append(m["cdata"])
            continue
        if m["tag"] is None or not m["end"]:  # a tag that the page's end cuts off is none
            continue
        tag = m["tag"].lower()
        if m["close"]:
            node = at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
            continue
        if tag in ("html", "body") and at is root and not any(isinstance(x, Node) and x.tag == tag for x in root.items):
            if tag == "html":
                root.attrs = m["attrs"]
                continue
        elif tag in ("html", "body"):
            continue
        if closes := CLOSES.get(tag):
            node = at
            while node is not None and node.tag not in closes and node.tag not in CONTAINERS:
                node = node.parent
            while node is not None and node.tag in closes and node.parent is not None:
                at = node = node.parent
        node = Node(tag, m["attrs"], at)
        at.items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
            node.items.append(page[pos:end.start() if end else len(page)])
            pos = end.end() if end else len(page)
        elif tag not in VOID and not m["attrs"].rstrip().endswith("/"):
            at = node
    return root


def kind_of(node: Node, in_article: bool) -> int:
    """What the element is by tag, role, class or id: KEEP; WRAPPER, boilerplate unless it is around the article; or GONE,
    without article text in any case. Page headers go; an article's own header stays."""
    if node.tag in NO_TEXT_TAGS:
        return GONE
    found = KEEP
    if node.tag in BOILERPLATE_TAGS or node.tag == "header" and not in_article:
        found = GONE if node.tag in NEVER_WRAPPERS else WRAPPER
    if not node.attrs or node.tag in _KEPT:
        return found
    for name, *values in _ATTR.findall(node.attrs):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return GONE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return GONE
        if name == "role" and value in BOILERPLATE_ROLES:
            found = max(found, WRAPPER)
        if name in ("class", "id"):
            for token in value.split():
                words = _NAME.findall(token)
                if words and words[0] not in _NEGATION and not BOILERPLATE_NAMES.isdisjoint(words):
                    found = max(found, WRAPPER if NEVER_WRAPPERS.isdisjoint(words) else GONE)
                if not in_article and not PAGE_NAMES.isdisjoint(words) and ARTICLE_NAMES.isdisjoint(words):
                    found = max(found, WRAPPER)
    return found


def _in_order(root: Node) -> list[Node]:
    """Nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in reversed(node.items) if isinstance(x, Node)]
    return out


def cut_boilerplate(root: Node) -> None:
    """Take boilerplate out of the tree. Wrappers of the article are told from boilerplate by the text outside links that
    they have and the rest of the page has. A page that marks its article outside of them has none."""
    kinds: dict[Node, int] = {root: KEEP}
    nodes, todo = [], [(root, False)]
    while todo:
        node, in_article = todo.pop()
        nodes.append(node)
        in_article = in_article or node.tag in ("article", "main")
        for x in node.items:
            if isinstance(x, Node):
                kinds[x] = kind_of(x, in_article)
        node.items = [x for x in node.items if isinstance(x, str) or kinds[x] != GONE]
        todo += [(x, in_article) for x in node.items if isinstance(x, Node)]
    own: dict[Node, int] = {}  # text of each node, without its boilerplate
    every: dict[Node, int] = {}  # and with what might be wrappers
    for node in reversed(nodes):
        children = [x for x in node.items if isinstance(x, Node)]
        text = sum(len(_SPACE.sub(" ", x).strip(" ")) for x in node.items if isinstance(x, str))
        link = node.tag == "a"
        own[node] = 0 if link else text + sum(own[x] for x in children if kinds[x] == KEEP)
        every[node] = 0 if link else text + sum(every[x] for x in children)
    rest, cut = own[root], _outermost(root, kinds)
    marked = any(x.tag in ("article", "main") and own[x] for x in _kept(root, kinds))
    while cut and not marked:
        x = max(cut, key=every.__getitem__)  # the first of equals
        if every[x] <= WRAPPER_RATIO * rest:
            break
        kinds[x] = KEEP
        rest += own[x]
        cut = [n for n in cut if n is not x] + _outermost(x, kinds)
    for node in nodes:
        node.items = [x for x in node.items if isinstance(x, str) or kinds[x] == KEEP]


def _kept(top: Node, kinds: dict[Node, int]) -> list[Node]:
    """Nodes that aren't inside boilerplate."""
    out, todo = [], [top]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [x for x in node.items if isinstance(x, Node) and kinds[x] == KEEP]
    return out


def _outermost(top: Node, kinds: dict[Node, int]) -> list[Node]:
    """Boilerplate below ``top`` that isn't inside other boilerplate, in no order that matters but the same each time."""
    return [x for node in _kept(top, kinds) for x in node.items if isinstance(x, Node) and kinds[x] != KEEP]


def measure(root: Node) -> None:
    """Characters, tags, link characters and link tags of every subtree, then densities and density sums."""
    nodes = _in_order(root)
    for node in reversed(nodes):
        own = sum(len(_SPACE.sub(" ", x).strip(" ")) for x in node.items if isinstance(x, str))
        children = [x for x in node.items if isinstance(x, Node)]
        node.chars = own + sum(x.chars for x in children)
        node.tags = len(children) + sum(x.tags for x in children)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        else:
            node.link_chars = sum(x.link_chars for x in children)
            node.link_tags = sum(x.link_tags for x in children)
    share = root.link_chars / max(1, root.chars)
    for node in reversed(nodes):
        node.density = composite_density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        node.total = sum(x.density for x in node.items if isinstance(x, Node))


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, page_share: float) -> float:
    """Characters per tag, weighed by a logarithm of how few of the characters and tags are links. The logarithm's
    base grows with link characters in the node and, by ``page_share``, in the page; it is e at least."""
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(1, chars - link_chars) + page_share * chars + math.e)
    few_links = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    return chars / max(1, tags) * math.log(max(few_links, 1.0)) / max(1.0, math.log(base))


def content_nodes(root: Node) -> list[Node]:
    """Roots of the subtrees that hold the main text, in page order."""
    nodes = _in_order(root)
    body = next((x for x in nodes if x.tag == "body"), root)
    nodes = _in_order(body)
    core = max(nodes, key=lambda x: x.total)  # the first of equals
    node = core
    while node is not body:  # an article's title and lead stand beside its densest part
        if node.tag == "article":
            core = node
            break
        node = node.parent
    threshold, node = core.density, core
    while node is not body:
        node = node.parent
        threshold = min(threshold, node.density)
    best: dict[Node, Node] = {}  # the node of the largest sum in each subtree
    for x in reversed(nodes):
        best[x] = max([x, *(best[c] for c in x.items if isinstance(c, Node))], key=lambda b: b.total)
    dense = [x for x in nodes if x.density >= threshold]
    chosen = {core, *(best[x] for x in dense if any(isinstance(c, Node) for c in x.items)),
              *(x for x in dense if x.tag in PARAGRAPHS)}
    if (title := _title_before(core, body)) is not None:
        chosen.add(title)
    out, todo = [], [body]
    while todo:  # a chosen node's subtree is taken whole, so what is chosen inside it needs no mark
        x = todo.pop()
        if x in chosen:
            out.append(x)
        else:
            todo += [c for c in reversed(x.items) if isinstance(c, Node)]
    return out


def _title_before(core: Node, body: Node) -> Node | None:
    """The nearest main heading that stands before the core beside it or beside an element around it; a short one is
    never as dense as the text below it."""
    node = core
    while node is not body:
        before = []
        for x in node.parent.items:
            if x is node:
                break
            if isinstance(x, Node):
                before.append(x)
        for x in reversed(before):
            heading = next((n for n in _in_order(x) if n.tag == "h1"), None)
            if heading is not None and x.chars == heading.chars > 0:
                return heading
        node = node.parent
    return None


def _text(nodes: list[Node]) -> str:
    """Texts of the subtrees: white space inside a block is one space, blocks are joined by one space."""
    parts: list[str] = []
    for root in nodes:
        parts.append(" ")
        todo: list[Node | str] = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                parts.append(x)
            elif x.tag == "br":
                parts.append(" ")
            else:
                edge = [] if x.tag in INLINE else [" "]
                todo += [*edge, *reversed(x.items), *edge]
    return _SPACE.sub(" ", "".join(parts)).strip(" ")


def main_text(page: str | None) -> str:
    """The page's main text; empty for null, empty and textless pages."""
    if not page:
        return ""
    root = parse(page)
    cut_boilerplate(root)
    measure(root)
    return _text(content_nodes(root))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points). Rows of null or repeated ids stay rows of their
    own; an empty table gives an empty result; other columns are not read."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def text(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in column:
            yield pd.Series([main_text(x) for x in s], dtype=object)

    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))

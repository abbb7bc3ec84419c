"""Main text of web pages by composite text density.

A page becomes a DOM (optional end tags implied, raw-text elements skipped). Elements that
are never article text - menus, page headers and footers, sidebars, forms, scripts, and those
whose class, id or role names an advert, a notice or comments, headings and paragraphs aside -
are cut off first, unless they hold most of the page. For every
other node the composite density relates characters to tags, adjusted for link characters and
link tags; the densities of its children add up to its density sum. The node with the largest
sum leads; the smallest density on its path from the body is the threshold, and every node at
or above it contributes its own largest-sum subtree. An ``article`` or ``main`` element around
a chosen subtree is taken whole, and otherwise the smallest subtree that spans all choices, so
that headings and short paragraphs between dense ones stay.

Defined results: null or empty html gives an empty text; markup that breaks off is closed at
the end of the page. ``br`` counts as a space. A null url stays null. Each row has its own
result, repeated ids too; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RAW = "script|style|noscript|template|iframe|textarea|title|svg|math|object|noembed|noframes|xmp"
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<({_RAW})(?=[\s/>])(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_BREAKS_OFF = re.compile(r"<(?:/?[a-zA-Z]|[!?])[^<>]*\Z")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption").split())
#: Start tag -> open elements that it ends, looked for no further than the scope on the right.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "tfoot": ({"tbody", "thead", "tr"}, {"table"}), "body": ({"head"}, set()),
}
#: Elements that can hold a whole article.
_HOLDS = frozenset("article aside blockquote body center div fieldset figure footer form header hgroup html main ol section table ul".split())
_P_SCOPE = frozenset("article aside section main div td th li body html blockquote button table figure form nav header footer".split())
_NEVER = frozenset("nav footer aside form head button select input menu dialog label datalist".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form toolbar".split())
#: Fixed value: name parts of classes and ids that mark what surrounds an article.
_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored sponsors promo promoted promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar skip sidebar aside rail footer masthead topbar "
    "cookie cookies consent gdpr notice notices notification alert banner popup modal overlay newsletter subscribe subscription signup "
    "paywall login comment comments commentlist disqus respond replies reply share sharing social related recommended recommendations "
    "widget widgets search searchbox form tags").split())
#: Fixed value: parts that form a compound with those names, as in ``share-buttons`` or ``main-nav``.
_BOX = frozenset((
    "box block bar wrap wrapper container section area list link links item items button buttons btn icon icons inner outer left right "
    "top bottom main site page global primary secondary post posts entry article articles story stories slot unit zone row col column "
    "text message thread count form field group panel title heading header head body footer google x").split())
_PLAIN = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
_LAYOUT = frozenset("no has with without".split())
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


class _Node:
    __slots__ = ("tag", "up", "kids", "cut", "chars", "tags", "links", "link_tags", "density", "sum", "plain", "holds")

    def __init__(self, tag, up, cut=0):
        self.tag, self.up, self.kids, self.cut = tag, up, [], cut


def _names(value: str) -> bool:
    for token in value.split():
        parts = [p.lower() for p in _PARTS.findall(token)]
        if not _LAYOUT.isdisjoint(parts):
            continue
        if any(p in _WORDS for p in parts) and all(p in _WORDS or p in _BOX for p in parts):
            return True
    return False


def _surrounds(tag: str, attrs: str, inside_article: bool) -> int:
    """1: cut unless it turns out to be around the page; 2: not shown, always cut; 0: kept."""
    if tag == "head" or _hidden(tag, attrs):
        return 2
    if tag in _NEVER or (tag == "header" and not inside_article):
        return 1
    if attrs and not attrs.isspace():
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'")
            if key == "role" and value.lower() in _ROLES:
                return 1
            if key in ("class", "id") and _names(value):
                if tag not in _PLAIN or tag in ("article", "main", "body", "html") and "comment" in value.lower():
                    return 1
    return 0


def _hidden(tag: str, attrs: str) -> bool:
    if not attrs or attrs.isspace() or tag in ("html", "body"):
        return False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'").replace(" ", "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value):
            return True
    return False


def _keep_wrappers(root: _Node) -> None:
    """Marked elements around the page are kept: those that hold an article or most of the
    text outside links, where the articles that stand outside hold little."""
    order, stack = [], [(root, False, False, False)]
    rest = 0                                      # text of articles outside marked elements
    while stack:
        n, link, article, marked = stack.pop()
        order.append(n)
        link, article, marked = link or n.tag == "a", article or n.tag in ("article", "main"), marked or n.cut > 0
        n.plain = 0 if link else sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        n.holds = n.tag in ("article", "main")
        rest += n.plain if article and not marked else 0
        stack.extend((k, link, article, marked) for k in n.kids if isinstance(k, _Node) and k.cut < 2)
    for n in reversed(order[1:]):
        n.up.plain, n.up.holds = n.up.plain + n.plain, n.up.holds or n.holds
    for n in order:
        if n.cut and (n.holds or 2 * n.plain > root.plain) and 4 * rest < n.plain:
            n.cut = 0


def parse(page: str) -> _Node:
    """DOM of a page; the root stands above ``html``. Text nodes are plain strings."""
    root = at = _Node("", None)
    where, articles = 0, 0

    def close(node):
        nonlocal at, articles
        while at is not node.up:
            articles -= at.tag in ("article", "main")
            at = at.up

    def opened(tags, scope):
        node = at
        while node is not root and node.tag not in scope:
            if node.tag in tags:
                return node
            node = node.up
        return None

    for m in _TOKEN.finditer(page):
        if m.start() > where:
            at.kids.append(page[where:m.start()])
        where = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            node = opened({tag}, frozenset() if tag in ("article", "main", "body", "html") else ("article",) if tag not in _BLOCK else ())
            if node is not None and tag not in ("body", "html"):
                close(node)
            continue
        if tag in _VOID:
            at.kids.append(_Node(tag, at))
            continue
        if tag in _BLOCK:
            node = opened({"p"}, _P_SCOPE)
            if node is not None:
                close(node)
        if tag in _ENDS:
            node = opened(*_ENDS[tag])
            if node is not None:
                close(node)
        node = _Node(tag, at, _surrounds(tag, m.group(4), articles > 0))
        at.kids.append(node)
        if not m.group(4).endswith("/") or tag not in ("path", "use", "circle"):
            at = node
            articles += tag in ("article", "main")
    rest = page[where:]
    if rest:
        at.kids.append(_BREAKS_OFF.sub("", rest))
    _keep_wrappers(root)
    return root


def _after(root: _Node):
    """Kept nodes, children before parents."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(k for k in node.kids if isinstance(k, _Node) and not k.cut)
    return reversed(out)


def _measure(root: _Node) -> list[_Node]:
    nodes = list(_after(root))
    for n in nodes:
        n.chars = n.tags = n.links = n.link_tags = 0
        for k in n.kids:
            if isinstance(k, str):
                n.chars += len(k.strip())
            elif not k.cut:
                n.chars, n.tags, n.links, n.link_tags = n.chars + k.chars, n.tags + k.tags + 1, n.links + k.links, n.link_tags + k.link_tags
        if n.tag == "a":
            n.links, n.link_tags = n.chars, n.tags + 1
    body = nodes[-1]
    share = body.links / max(body.chars, 1)
    for n in nodes:
        c, t, lc, lt = n.chars, max(n.tags, 1), max(n.links, 1), max(n.link_tags, 1)
        if not c:
            n.density = 0.0
        else:
            base = math.log(c / max(c - n.links, 1) * n.links + share * c + math.e)
            n.density = c / t * max(math.log(max(c / lc * t / lt, 1.0)), 0.0) / math.log(max(base, 1 + 1e-9) + 1e-9) if base > 1 + 1e-6 else c / t * math.log(max(c * t / (lc * lt), 1.0) + 1)
    for n in nodes:
        inner = [k.density for k in n.kids if isinstance(k, _Node) and not k.cut]
        n.sum = sum(inner) if any(inner) else n.density
    return nodes


def _leader(node: _Node) -> _Node:
    """The node of the subtree with the largest density sum; the outermost of equals."""
    best, stack = node, [node]
    while stack:
        n = stack.pop()
        if n.sum > best.sum:
            best = n
        stack.extend(k for k in n.kids if isinstance(k, _Node) and not k.cut)
    return best


def _path(node: _Node) -> list[_Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.up
    return out[::-1]


def choose(root: _Node) -> _Node | None:
    """The subtree that holds the main text."""
    nodes = _measure(root)
    body = next((n for n in reversed(nodes) if n.tag == "body"), root)
    if not body.chars:
        body = root
    if not body.chars:
        return None
    lead = _leader(body)
    threshold = min(n.density for n in _path(lead) if n.up is not None or n is body)
    chosen, queue = [lead], [body]
    while queue:
        for k in queue.pop().kids:
            if isinstance(k, _Node) and not k.cut and k.chars and k.density >= threshold:
                best = _leader(k)
                chosen.append(best)
                if best is not k:
                    queue.append(k)
    common = _path(chosen[0])
    for n in chosen[1:]:
        other = _path(n)
        common = [a for a, b in zip(common, other) if a is b]
    node = common[-1]
    while node is not body and node.up is not None and node.tag not in _HOLDS:
        node = node.up                        # a paragraph or list item is never the whole text
    whole = next((p for p in _path(node) if p.tag in ("article", "main")), None)
    if whole is not None and 2 * (whole.links - node.links) <= whole.chars - node.chars:
        return whole
    return node


def render(node: _Node) -> str:
    """Blocks of a subtree in page order, one a line."""
    blocks, held = [], []

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            blocks.append(text)

    stack: list = [node]
    while stack:
        k = stack.pop()
        if k is None:
            flush()
        elif isinstance(k, str):
            held.append(k)
        elif k.cut:
            if k.tag in _BLOCK:
                flush()
        elif k.tag == "br":
            held.append(" ")
        else:
            if k.tag in _BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(k.kids))
    flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    node = choose(root)
    return render(node) if node is not None else ""


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return page.map(main_text, na_action=None)

    got = pages.select("page_id", "url", text(F.coalesce(F.col("html").cast("string"), F.lit(""))).alias("text"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

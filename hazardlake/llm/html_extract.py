"""Main text of web pages by composite text density.

Each page becomes a light element tree. For every node, with C characters, T
tags, LC link characters and LT link tags below it, the link-adjusted density is

    C/T * log_b((C * T) / (LC * LT)),  b = ln(C * LC / (C - LC) + C * LC_body / C_body + e)

(zeros count as 1). A node's density sum adds its children's densities. The node
with the largest sum marks the article; the smallest density on its path to the
body is the threshold, and subtrees and loose text at or above it join the text,
on every page. ``article`` and ``main`` elements refine this: a ``main`` that is the
outermost one around the marked node bounds the text, an ``article`` around the
node is kept whole, and outside of a ``main`` only its like join it; a marked
node outside of them that has at least half of its characters in such elements
stands for the largest one. Inside a ``main`` headings ``h1`` join, and a further
``article`` or ``main`` also joins with at least half as much unlinked text per
tag as the marked one (the density favours size, so shorter neighbours would
miss the threshold).

Menus, headers, footers, side bars, notices, adverts, forms, scripts, styles
and reader comments are pruned first: by element, role and class name. A class
or id counts if all of it is such a name, alone or with words of place and form
("sidebar", "cookie-notice", "page-header", not "no-sidebar" or "header-files").
A node that holds the page's ``h1`` or ``main`` is never pruned by its class, nor is
one with most of the page's unlinked text while no ``article``, ``main`` or ``h1``
outside of it has text. An unclosed element whose content is skipped ends at
the next block tag (scripts and styles go on to the end).
Character references are decoded, white space inside a block becomes one space,
and blocks are joined in page order by one space. A null or empty page, or one
without text, gives an empty string. One page is worked on in memory; time is linear in the
length of ordinary markup (stray end tags and unclosed quotes cost its square).
"""

from __future__ import annotations

import bisect
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*>|(<)(?=[a-zA-Z!?/])", re.S)
_START = re.compile(r"<!--.*?(?:-->|\Z)|<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|[!?/])", re.S)
_SIGN = re.compile("[>\"']")
_ATTR = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORDS = re.compile(r"[a-z]+")

# Fixed element names.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "head", "header", "hr", "html", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK))})(?=[\s/>])", re.I)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "table", "dl", "body", "div", "section", "article"}
_LOOK = {name: sorted(_CLOSES.get(name, set()) | {"p"} | _SCOPE) for name in [*_CLOSES, "p"]}
_DROP = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "head"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
          "menubar", "form"}
_CLASSES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion",
            "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notification", "alert", "popup", "modal",
            "overlay", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination",
            "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "signup", "footer",
            "masthead", "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "widget",
            "toolbar", "skip", "header", "topbar", "aside", "login", "search", "copyright"}


#: Words that may stand beside a name of ``_CLASSES`` in one class or id.
_BESIDE = {"a", "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "center", "col", "column",
           "container", "content", "desktop", "div", "fixed", "form", "global", "group", "holder", "icons", "inner", "item",
           "items", "js", "left", "link", "links", "list", "main", "media", "mobile", "outer", "page", "panel", "post",
           "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "stories",
           "article", "articles", "text", "the", "thread", "title", "top", "unit", "user", "wrap", "wrapper", "web"}
_NAMED = {"article", "main"}


class _Node:
    __slots__ = ("tag", "parts", "parent", "drop", "hinted", "classed", "titled", "depth", "c", "t", "lc", "lt", "density", "total")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.drop = self.hinted = self.classed = self.titled = False
        self.c = self.t = self.lc = self.lt = 0
        self.density = self.total = 0.0


def _noise(name: str) -> bool:
    """Whether one class or id, as a whole, names a part that is pruned."""
    words = _WORDS.findall(name)
    return not _CLASSES.isdisjoint(words) and all(w in _CLASSES or w in _BESIDE for w in words)


def _judge(node: _Node, attrs: str) -> None:
    """Prune by element name, or note a hint in role, class, id or visibility."""
    tag = node.tag
    up = node.parent
    if tag in _DROP:
        inside = False
        while tag == "header" and up is not None and not inside:
            inside, up = up.tag in ("article", "main"), up.parent
        node.drop = not inside
    if not attrs:
        return
    for name, *values in _ATTR.findall(attrs):
        value = "".join(values).lower()
        name = name.lower()
        if name == "role" and value in _ROLES or name == "aria-hidden" and value == "true" or (
                name == "style" and "display:none" in value.replace(" ", "")):
            node.hinted = tag not in ("html", "body", "main")
        elif name in ("class", "id") and any(map(_noise, value.split())):
            node.classed = tag not in ("html", "body", "main")
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", attrs):
        node.hinted = True


def _closing(page: str, at: int) -> tuple[list[int], list[int]]:
    """Positions of quotes and ``>`` from ``at`` on, and where a tag that is open there ends (-1: nowhere)."""
    signs = [m.start() for m in _SIGN.finditer(page, at)]
    ends, later = [-1] * (len(signs) + 1), {}
    for i in range(len(signs) - 1, -1, -1):
        sign = page[signs[i]]
        if sign == ">":
            ends[i] = signs[i]
        else:
            if sign in later:
                ends[i] = ends[later[sign] + 1]
            later[sign] = i
    return signs, ends


class _Tags:
    """Comments and tags of a page, from any position onwards.

    A quote that is never closed does not hide the tags behind it: such a tag ends at its first ``>``. From the
    first one on, the ends of all tags come from one pass over the rest, so that each character is seen a few times only.
    """

    def __init__(self, page: str):
        self.page, self.signs, self.ends = page, None, None

    def after(self, at: int):
        """(start, end, closing, name, attributes) of the next one, or None; name is empty where there is none."""
        page = self.page
        if self.signs is None:
            m = _TAG.search(page, at)
            if not m:
                return None
            if not m.group(4):
                return m.start(), m.end(), m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
            at = m.start()
            self.signs, self.ends = _closing(page, at)
        while m := _START.search(page, at):
            at, name = m.end(), m.group(2)
            if m.group().startswith("<!--"):
                return m.start(), at, "", "", ""
            end = self.ends[bisect.bisect_left(self.signs, at)] if name else -1
            if end < 0:
                end = page.find(">", at)
            if end >= 0:
                return m.start(), end + 1, m.group(1), (name or "").lower(), page[at:end] if name else ""
            # No tag can end any more; only a comment may still start.
            at = page.find("<!--", at)
            if at < 0:
                return None
        return None


def parse(page: str) -> _Node:
    """Element tree of a page; text parts are decoded strings. Unclosed and stray tags are tolerated."""
    root = _Node("body", None)
    cur, at, size, unclosed = root, 0, len(page), set()
    last = page.rfind(">") + 1
    opened: dict[str, list[_Node]] = {}   # open elements by name, innermost last

    def leave(node: _Node) -> _Node:
        up = cur
        while True:
            opened[up.tag].pop()
            if up is node:
                return up.parent
            up = up.parent

    tags = _Tags(page)
    while at < size:
        found = tags.after(at)
        text = page[at:found[0]] if found else page[at:]
        if text:
            cur.parts.append(html.unescape(text) if "&" in text else text)
        if not found:
            break
        _, at, closing, name, attrs = found
        if not name:
            continue
        if closing:
            if opened.get(name):
                cur = leave(opened[name][-1])
            elif name in _BLOCK:
                cur.parts.append(" ")
            continue
        if name in _RAW and not attrs.endswith("/"):
            end = None if name in unclosed else re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at, last)
            if end:
                at = end.end()
                continue
            unclosed.add(name)
            block = None if name in ("script", "style") else _BLOCK_TAG.search(page, at)
            at = block.start() if block else size
            continue
        if name in ("html", "body"):
            continue
        if name in _VOID or attrs.endswith("/") and name not in _BLOCK:
            cur.parts.append(" " if name in _BLOCK else "")
            continue
        if name in _BLOCK:
            # The innermost open element that it closes or that bounds the search.
            near = root
            for tag in _LOOK.get(name, _LOOK["p"]):
                if opened.get(tag) and opened[tag][-1].depth > near.depth:
                    near = opened[tag][-1]
            if near.tag not in _SCOPE:
                cur = leave(near)
        node = _Node(name, cur)
        opened.setdefault(name, []).append(node)
        cur.parts.append(node)
        _judge(node, attrs)
        if name in ("h1", "main"):
            up = node
            while up is not None and not up.titled:
                up.titled = True
                up = up.parent
        cur = node
    return root


def _pruned(node: _Node) -> bool:
    return node.drop or (node.hinted or node.classed) and not node.titled


def _spare(root: _Node) -> None:
    """Takes back the class hint of a node with most of the unlinked text, if no named text is outside of it."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.parts if not isinstance(x, str) and not x.drop]
    if not any(n.classed and not n.titled for n in order):
        return
    plain, named = {}, {}
    for node in reversed(order):
        size = 0 if node.tag == "a" else sum(
            len("".join(x.split())) if isinstance(x, str) else plain.get(id(x), 0) for x in node.parts)
        plain[id(node)] = size
        named[id(node)] = size if node.tag in _NAMED or node.tag == "h1" else sum(
            named.get(id(x), 0) for x in node.parts if not isinstance(x, str))
    for node in order:
        if (node.classed and 2 * plain[id(node)] > plain[id(root)]
                and named[id(node)] == named[id(root)]):
            node.classed = False


def _kept(node) -> list:
    return [x for x in node.parts if isinstance(x, str) or not _pruned(x)]


def _walk(root: _Node) -> list[_Node]:
    """Nodes in page order without pruned subtrees (no recursion, so depth is unbounded)."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        node.parts = _kept(node)
        out.append(node)
        todo += [x for x in reversed(node.parts) if not isinstance(x, str)]
    return out


def _link_share(body: _Node) -> float:
    return body.lc / max(1, body.c)


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    if not c:
        return 0.0
    t, lc, lt = max(1, t), max(1, lc), max(1, lt)
    base = math.log(c * lc / max(1, c - lc) + share * c + math.e)
    return c / t * math.log(max(1.0, c * t / (lc * lt))) / math.log(max(base, 1.001))


def _measure(nodes: list[_Node]) -> None:
    for node in reversed(nodes):
        own = sum(len("".join(x.split())) for x in node.parts if isinstance(x, str))
        node.c += own
        if node.tag == "a":
            node.lc, node.lt = node.c, node.lt + 1
        if node.parent is not None:
            up = node.parent
            up.c, up.t, up.lc, up.lt = up.c + node.c, up.t + node.t + 1, up.lc + node.lc, up.lt + node.lt
    share = _link_share(nodes[0])
    for node in nodes:
        node.density = _density(node.c, node.t, node.lc, node.lt, share)
        if node.parent is not None:
            node.parent.total += node.density


def _text(nodes: list[_Node | str]) -> str:
    out = []
    for top in nodes:
        todo = [top]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
                continue
            gap = [" "] if x.tag in _BLOCK else []
            todo += gap + x.parts[::-1] + gap
        out.append(" ")
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    """The article's text of one page."""
    if not page:
        return ""
    root = parse(page)
    _spare(root)
    nodes = _walk(root)
    _measure(nodes)
    body = nodes[0]
    best = max(nodes, key=lambda n: n.total)
    if not best.total:
        return _text([body])
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    threshold, share = min(n.density for n in above), _link_share(body)
    # Ancestors of article and main elements are looked into.
    holds = set()
    for node in nodes:
        up = node.parent if node.tag in _NAMED else None
        while up is not None and id(up) not in holds:
            holds.add(id(up))
            up = up.parent
    named = [n for n in above if n.tag in _NAMED]
    bound, marked, only_named = body, best, False
    if named:
        only_named = named[-1].tag == "article"
        bound = body if only_named else named[-1]
        marked = next((n for n in reversed(named) if n.tag == "article"), best)
    else:
        inside = _topmost_named(best)
        if 2 * sum(n.c for n in inside) >= best.c:
            marked = max(inside, key=lambda n: n.c)
    path, up = set(), marked.parent
    while up is not None:
        path.add(id(up))
        up = up.parent
    least = (marked.c - marked.lc) / max(1, marked.t) / 2
    # Parts that join, topmost first, in page order; the marked node always counts.
    chosen, todo = [], [bound]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            if not only_named and _density(len("".join(node.split())), 0, 0, 0, share) >= threshold:
                chosen.append(node)
        elif node is marked:
            chosen.append(node)
        elif id(node) in path:
            todo += node.parts[::-1]
        elif node.c and (node.tag in _NAMED and node.c - node.lc >= least * max(1, node.t)
                         or (node.tag in _NAMED or not only_named) and node.density >= threshold
                         or bound is not body and node.tag == "h1"):
            chosen.append(node)
        elif id(node) in holds or bound is not body and node.titled:
            todo += node.parts[::-1]
    return _text(chosen)


def _topmost_named(top: _Node) -> list[_Node]:
    found, todo = [], [top]
    while todo:
        node = todo.pop()
        if node.tag in _NAMED:
            found.append(node)
        else:
            todo += [x for x in reversed(node.parts) if not isinstance(x, str)]
    return found


def _mapper(batches):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html)."""
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
            .mapInArrow(_mapper, "page_id long, url string, text string, n_chars long"))

"""Main text of web pages by tree scoring (operator 7).

A page is parsed into a tree of block elements. Blocks that are no part of an
article by their tag, role or name are cut off; a name does not count where it only
describes the block ("has-sidebar") or where the block holds the page's article. Every
paragraph passes points for its length and commas to the ``LEVELS`` ancestors next to it,
less the further up; a container's score is discounted by its link density. The best
container is kept with those siblings that score well or read as text, and gives its
blocks in page order. Blocks nested deeper than ``DEPTH`` are taken as siblings, as
browsers do, so that time is linear in the page.

An element that is no text (a button, an svg ...) but is not closed ends with its
parent block; then what follows from its first block on is text after all. A head
needs no end, as all that may stand in it is no text by itself.

Defined results: null, empty and text-free html give the empty string; broken
markup is read as browsers do it for paragraphs and list items; texts of any length are
read whole; of containers with equal scores the first in page order counts; repeated
rows give repeated results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from itertools import chain, islice

from pyspark.sql import DataFrame

from .common import map_batches

# HTML's block elements, those without an end tag, and those that are no text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
SILENT = frozenset("script style noscript template title iframe object svg canvas math select button textarea audio video".split())
CUT_TAGS = frozenset("nav aside footer form dialog menu fieldset".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar form".split())
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar aside nav navbar "
    "navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar comment comments disqus respond replies cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations widget pagination pager skip discussion discussions feedback "
    "responses reply guestbook".split()
)
#: Parts of a name that make it a description of the block that bears it.
DESCRIBING = frozenset("has no not with without is enabled disabled open opened closed layout".split())
KEEP_TAGS = frozenset(("html", "body", "article", "main"))
CONTENT_NAMES = frozenset("article content main body entry post story text".split())
#: What an open paragraph or item ends at.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
#: Silent elements that their own start tag ends, and those that a block's start ends outside of the listed elements.
_SINGLE = frozenset(("button", "select"))
_FOREIGN = frozenset(("svg", "math"))
_FOREIGN_HTML = frozenset(("foreignobject", "annotation-xml"))
_NAME = re.compile(r"[a-z0-9]+")
#: Blocks nested deeper are siblings of those at this depth.
DEPTH = 512
#: Ancestors that a paragraph's points reach.
LEVELS = 8


class Node:
    __slots__ = ("tag", "names", "cut_names", "role", "hidden", "parent", "parts", "score", "length", "linked", "depth", "in_article", "holds")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        words = [_NAME.findall(x) for x in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()]
        self.names = {x for word in words for x in word}
        self.cut_names = any(not CUT_NAMES.isdisjoint(word) and DESCRIBING.isdisjoint(word) for word in words)
        self.in_article = parent is not None and (parent.in_article or parent.tag in ("article", "main"))
        #: whether the page's article is in it
        self.holds = False
        self.role = (attrs.get("role") or "").lower()
        style = (attrs.get("style") or "").replace(" ", "").lower()
        self.hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style
        #: child nodes, and (text, whether linked)
        self.parts: list = []
        self.score = 0.0
        self.length = self.linked = 0

    def is_cut(self) -> bool:
        if self.hidden or self.tag in CUT_TAGS or self.role in CUT_ROLES:
            return True
        if self.tag == "header":
            # the head of an article is text; that of a page is not
            return not self.in_article
        if self.tag in KEEP_TAGS:
            # readers' comments may be articles too
            return self.tag == "article" and self.in_article and self.cut_names
        return self.cut_names and not self.holds

    def is_article(self) -> bool:
        return self.tag == "main" or self.role == "main" or (self.tag == "article" and not self.cut_names)

    def above(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class TreeBuilder(HTMLParser):
    """Block elements as nodes; inline markup is only text, but for links."""

    # of the others tags are seen, so that one without an end does not take the page along
    CDATA_CONTENT_ELEMENTS = ("script", "style")
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", {}, None)
        #: all blocks, parents first, and how many of each tag are open
        self.nodes = [self.root]
        self.open: Counter[str] = Counter()
        self.links = self.silent = 0
        self.silent_tag = ""
        #: what came since silence began, blocks opened in it, and silent tags that are read as text
        self.held: list[tuple] = []
        self.inside: list[str] = []
        self.plain: set[str] = set()

    def close(self):
        super().close()
        while self.silent:
            self._release()

    def _release(self) -> None:
        """End a silent element that was not closed; from its first block on, what it held is read again."""
        tag, held = self.silent_tag, self.held
        self.silent, self.held, self.inside = 0, [], []
        at = next((i for i, (kind, x, *_) in enumerate(held) if kind == "start" and x in BLOCKS), len(held))
        # each tag is read as text within itself, so that a page is read again at most once for each
        known, self.plain = self.plain, self.plain | {tag}
        for kind, *args in held[at:]:
            (self.handle_starttag if kind == "start" else self.handle_endtag if kind == "end" else self.handle_data)(*args)
        while self.silent:
            self._release()
        self.plain = known

    def _is_open(self, tags: tuple, stops: tuple = ()) -> bool:
        if not any(self.open[t] for t in tags):
            return False
        node = self.at
        while node is not None and node.parent is not None and node.tag not in stops:
            if node.tag in tags:
                return True
            node = node.parent
        return False

    def _start_ends(self, tag: str) -> bool:
        """Whether a start tag ends the silent element it stands in, or that element's parent."""
        if tag == "body" or (tag == self.silent_tag and tag in _SINGLE):
            return True
        if self.silent_tag in _FOREIGN:
            return tag in BLOCKS and _FOREIGN_HTML.isdisjoint(self.inside)
        return tag in _ENDS and set(_SCOPE[tag]).isdisjoint(self.inside) and self._is_open(_ENDS[tag], _SCOPE[tag])

    def handle_starttag(self, tag, attrs):
        if self.silent:
            if not self._start_ends(tag):
                self.held.append(("start", tag, attrs))
                self.silent += tag == self.silent_tag
                if tag in BLOCKS or tag in _FOREIGN_HTML:
                    self.inside.append(tag)
                return
            self._release()
        if tag in SILENT and tag not in self.plain:
            self.silent, self.silent_tag = 1, tag
        elif tag == "a":
            self.links = 1
        elif tag in ("br", "hr", "img", "input"):
            self.at.parts.append((" ", False))
        elif tag in BLOCKS and tag not in ("html", "body"):
            self.links = 0
            self._close({"p"}, BLOCKS - {"p"})
            if tag in _ENDS:
                self._close(set(_ENDS[tag]), set(_SCOPE[tag]))
            if self.at.depth >= DEPTH:
                self._leave(self.at.parent)
            node = Node(tag, dict(attrs), self.at)
            self.at.parts.append(node)
            self.nodes.append(node)
            self.open[tag] += 1
            self.at = node

    def handle_startendtag(self, tag, attrs):
        if tag not in SILENT:
            self.handle_starttag(tag, attrs)
            if tag in BLOCKS:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.silent:
            if tag == self.silent_tag:
                self.silent -= 1
                if not self.silent:
                    self.held, self.inside = [], []
                    return
            elif tag in self.inside:
                while self.inside.pop() != tag:
                    pass
            elif tag in ("head", "body", "html") or (tag in BLOCKS and self._is_open((tag,))):
                self._release()
            if self.silent:
                self.held.append(("end", tag))
                return
        if tag == "a":
            self.links = 0
        elif tag in BLOCKS and tag not in ("html", "body", "hr"):
            self.links = 0
            self._close({tag}, set())

    def _close(self, tags: set, stops: set | frozenset) -> None:
        """Close the nearest open element of ``tags`` unless one of ``stops`` is nearer."""
        if not any(self.open[t] for t in tags):
            return
        node = self.at
        while node.parent is not None:
            if node.tag in tags:
                self._leave(node.parent)
                return
            if node.tag in stops:
                return
            node = node.parent

    def _leave(self, parent: Node) -> None:
        """Close all open blocks below ``parent``."""
        while self.at is not parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_data(self, data):
        if self.silent:
            self.held.append(("data", data))
        elif data:
            self.at.parts.append((data, bool(self.links)))


def _tree(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    for node in reversed(builder.nodes):
        if node.parent is not None and not node.hidden and (node.holds or node.is_article()):
            node.parent.holds = True
    return builder.root


def _nodes(root: Node) -> list[Node]:
    """Nodes that are not cut off, parents first, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        node.parts = [p for p in node.parts if not (isinstance(p, Node) and p.is_cut())]
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return out


def _own(node: Node) -> str:
    """The text of a node outside its child blocks, white space folded."""
    return " ".join("".join(p[0] if isinstance(p, tuple) else " " for p in node.parts).split())


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def main_text(html: str | None) -> str:
    """The article of a page as one line of text."""
    if not html:
        return ""
    nodes = _nodes(_tree(html))
    for node in nodes:
        text = _own(node)
        linked = sum(len(p[0]) for p in node.parts if isinstance(p, tuple) and p[1])
        node.length, node.linked = len(text), min(linked, len(text))
        if not text:
            continue
        share = 1 - _density(node)
        points = share * (1 + text.count(",") + min(len(text) / 100, 3))
        # a paragraph's points go up; text right inside a container counts for itself
        weight = 1.0
        holder = node if node.tag in ("div", "section", "article", "main", "td", "html") else node.parent
        for level, up in enumerate(islice(chain([holder], holder.above()), LEVELS) if holder else ()):
            weight = 1.0 if level == 0 else 0.5 if level == 1 else 1 / (3 * level)
            up.score += points * weight
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    for node in nodes:
        if node.tag in ("article", "main") or node.role == "main":
            node.score += 25 if node.length else 0
        elif node.names & CONTENT_NAMES and node.tag in ("div", "section", "td"):
            node.score += 5 if node.length else 0
        node.score *= 1 - _density(node)
    holders = [n for n in nodes if n.tag not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd") and n.length]
    if not holders:
        return ""
    best = max(holders, key=lambda n: n.score)
    for up in best.above():
        if (up.tag in ("article", "main") or up.role == "main") and _density(up) < 0.5:
            best = up
    return _joined(_kept(best))


def _kept(best: Node) -> list:
    """The best container with those of its siblings that belong to the text."""
    if best.parent is None:
        return [best]
    least = max(5.0, 0.2 * best.score)
    out: list = []
    for part in best.parent.parts:
        if part is best:
            out.append(part)
        elif isinstance(part, Node) and part.length:
            prose = part.tag in ("p", "h1", "h2", "pre", "blockquote") and _density(part) < 0.25
            same = part.tag == best.tag == "article" or (part.names and part.names == best.names)
            if prose or part.score + (0.2 * best.score if same else 0) >= least and _density(part) < 0.5:
                out.append(part)
    return out


def _joined(parts: list) -> str:
    """Text of parts in page order; a block's border is white space."""
    out: list[str] = []
    todo = list(reversed(parts))
    while todo:
        part = todo.pop()
        if isinstance(part, Node):
            todo.append((" ", False))
            todo += reversed(part.parts)
            todo.append((" ", False))
        else:
            out.append(part[0])
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def step(rows: dict[str, list]) -> dict[str, list]:
        texts = [main_text(h) for h in rows["html"]]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages, ["page_id", "url", "html"], "page_id bigint, url string, text string, n_chars bigint", step)

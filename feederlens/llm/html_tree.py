"""A page as a tree of blocks with observed features."""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video textarea select option datalist title".split())
#: Of those, the ones that a block ends where they were left open.
BROKEN_BY_BLOCKS = frozenset("svg math iframe".split())
#: Elements that are no blocks of their own: the page's one block is the root.
FRAMES = frozenset("html head body".split())
#: Elements whose own text is a block; elsewhere text gets a block of its own.
TEXTUAL = frozenset("p pre h1 h2 h3 h4 h5 h6 li dt dd blockquote figcaption address caption legend summary label button".split())
#: Elements that do not break a line; br is white space.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of the key closes open elements of the value, up to the nearest element of the third.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}

TAGS = {
    "nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form",
    "button": "form", "fieldset": "form", "dialog": "form", "input": "form",
    "article": "article", "main": "main", "section": "box", "div": "box", "center": "box", "details": "box",
    "p": "text", "blockquote": "text", "pre": "text", "figcaption": "text", "address": "address",
    "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading",
    "ul": "list", "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item",
    "table": "table", "tbody": "table", "thead": "table", "tr": "table", "td": "cell", "th": "cell",
    "#root": "root", "#text": "text", "figure": "figure",
}

#: Words of class, id and role, and what they speak for.
HINTS = {
    "content": "article content main post entry body story text blog prose".split(),
    "comment": "comment comments reply replies disqus discussion respond".split(),
    "frame": "nav navbar navigation menu footer foot header head masthead sidebar side widget breadcrumb breadcrumbs "
    "pagination pager toolbar topbar banner contentinfo complementary rail".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted".split(),
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert subscribe newsletter signup login share "
    "sharing social related recommended tags meta byline copyright legal disclaimer search hidden".split(),
}
_HINT = {word: kind for kind, words in HINTS.items() for word in words}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SENTENCE = ".,;:!?"


class Node:
    __slots__ = ("tag", "hints", "parent", "children", "runs", "chars", "linked", "marks", "label")

    def __init__(self, tag: str, hints: frozenset[str], parent: Node | None, label: int | None):
        self.tag, self.hints, self.parent, self.label = tag, hints, parent, label
        self.children: list[Node] = []
        self.runs: list[tuple[int, list[str]]] = []
        self.chars = self.linked = self.marks = 0


def hints_of(attrs: list[tuple[str, str | None]]) -> frozenset[str]:
    """All that class, id, role and hiding of an element speak for."""
    found = set()
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            found.update(_HINT[w.lower()] for w in _WORD.findall(value) if w.lower() in _HINT)
        elif name == "hidden" or name == "style" and value and "display:none" in value.replace(" ", ""):
            found.add("notice")
    return frozenset(found)


class Tree(HTMLParser):
    """Block elements as nodes in page order; text belongs to the block around it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", frozenset(), None, None)
        self.nodes = [self.root]
        self.open: list[tuple[str, Node]] = []
        self.node = self.root
        self.silent = self.links = 0
        self.blocks: list[tuple[Node, list[str]]] = []
        self.run: list[str] | None = None
        self.at = 0
        #: By silent tag, where the page last closes one.
        self.lowered, self.last_end = html.lower(), {}
        self.feed(html)
        self.close()

    def parse_starttag(self, i):
        self.at = i
        return super().parse_starttag(i)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag not in INLINE:
                self.run = None
            return
        label = next((int(v) for k, v in attrs if k == "data-label" and v in ("0", "1")), None)
        if tag in FRAMES:
            if tag != "head" and label is not None:
                self.root.label = label
            return
        if tag not in INLINE and tag not in SILENT:
            self._break_out()
        if tag not in INLINE:
            self._imply(tag)
        if tag in SILENT:
            # One that nothing closes does not silence the rest of the page.
            if self.at < self._last_end(tag):
                self.silent += 1
                self.open.append((tag, self.node))
            return
        if tag == "a":
            self.links += 1
        if tag not in INLINE:
            before, self.node = self.node, self._child(tag, hints_of(attrs), label)
            self.open.append((tag, before))
            self.run = None
        else:
            self.open.append((tag, self.node))

    def _child(self, tag, hints, label) -> Node:
        child = Node(tag, hints, self.node, label)
        self.node.children.append(child)
        self.nodes.append(child)
        return child

    def _last_end(self, tag) -> int:
        if tag not in self.last_end:
            self.last_end[tag] = self.lowered.rfind(f"</{tag}")
        return self.last_end[tag]

    def _break_out(self):
        """A block ends drawings and embedded pages that were left open."""
        while self.silent and self.open and (self.open[-1][0] in BROKEN_BY_BLOCKS or self.open[-1][0] in INLINE):
            self._close_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or tag in FRAMES:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close_to(at)
                return
            # An inline end tag does not close a block around it.
            if tag in INLINE and self.open[at][0] not in INLINE:
                return

    def handle_data(self, data):
        if self.silent or not data:
            return
        if self.run is None:
            if not data.strip():
                return
            self.run = []
            # Text right in a container is a block of its own.
            of = self.node if self.node.tag in TEXTUAL else self._child("#text", frozenset(), None)
            self.blocks.append((of, self.run))
        self.run.append(data)
        node, shown = self.blocks[-1][0], len(data.strip())
        node.chars += shown
        node.linked += shown if self.links else 0
        node.marks += sum(map(data.count, _SENTENCE))

    def _imply(self, tag):
        closes, until = _CLOSES.get(tag, ({"p"}, set()))
        closes = closes | {"p"}
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in closes:
                self._close_to(at)
                if name == "p" and tag not in _CLOSES:
                    return
            elif name in until or name not in INLINE and name != "p" and tag not in _CLOSES:
                return

    def _close_to(self, at):
        while len(self.open) > at:
            tag, before = self.open.pop()
            if tag in SILENT:
                self.silent -= 1
            elif tag == "a":
                self.links = max(0, self.links - 1)
            if tag not in INLINE:
                self.run = None
            self.node = before

    def texts(self) -> list[tuple[Node, str]]:
        """Blocks of text in page order, white space as one space, none empty."""
        plain = ((node, " ".join("".join(run).split())) for node, run in self.blocks)
        return [(node, text) for node, text in plain if text]


def _bin(value: float, bounds: tuple) -> int:
    return sum(value >= b for b in bounds)


def features(nodes: list[Node]) -> list[tuple[str, ...]]:
    """Observed values of each node; texts below a node count for it too."""
    sums = {id(n): [n.chars, n.linked, n.marks] for n in nodes}
    for node in reversed(nodes):
        if node.parent is not None:
            for i, v in enumerate(sums[id(node)]):
                sums[id(node.parent)][i] += v
    found = []
    for node in nodes:
        chars, linked, marks = sums[id(node)]
        density = f"l{_bin(linked / chars, (0.01, 0.3, 0.6, 0.9))}" if chars else "l-"
        found.append((
            "tag:" + TAGS.get(node.tag, "other"),
            *[f"{kind}:{kind in node.hints}" for kind in HINTS],
            "links:" + density,
            f"size:{_bin(chars, (1, 25, 80, 300))}",
            f"marks:{_bin(100 * marks / chars, (0.2, 1.0)) if chars else '-'}",
        ))
    return found

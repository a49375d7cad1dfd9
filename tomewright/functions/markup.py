"""Elements of an HTML page as a tree in document order: one pass over its events with a stack of open elements.

Every node knows where it stands in the source, so what is cut out is verbatim. End tags close what is open inside them, end
tags without a start are passed over, and starts that can't stand inside an open element close it first. This is the small
helper that the page operators call for each page; what is made of the nodes is done in Spark."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Elements without content, elements that break lines, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("p div li ul ol table tr blockquote h1 h2 h3 h4 h5 h6".split())
SILENT = frozenset("script style".split())
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody")}
_HOLDERS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}

#: Stands in raw text where the markup breaks a line.
BREAK = "\x1e"


@dataclass
class Node:
    """An element, or with an empty tag a run of text. start and stop bound it in the source, inner_start and inner_stop its content."""

    tag: str
    start: int
    attributes: dict[str, str] = field(default_factory=dict)
    text: str = ""
    inner_start: int = 0
    inner_stop: int = 0
    stop: int = 0
    children: list[Node] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self):
        """All nodes below, in document order, without recursion."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def first(self, selector: str) -> Node | None:
        return next((n for n in self.walk() if matches(n, selector)), None)

    def raw_text(self) -> str:
        """Text with breaks for block elements and line ends, its white space as it stands; scripts and styles are silent."""
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif not node.tag:
                out.append(node.text)
            elif node.tag == "br":
                out.append(BREAK)
            elif node.tag not in SILENT:
                if node.tag in BREAKS:
                    out.append(BREAK)
                    stack.append(BREAK)
                stack.extend(reversed(node.children))
        return "".join(out)


def matches(node: Node, selector: str) -> bool:
    """``tag``, ``#id``, ``.class`` or ``tag.class``."""
    if selector.startswith("#"):
        return node.attributes.get("id") == selector[1:]
    tag, _, name = selector.partition(".")
    return bool(node.tag) and (not tag or node.tag == tag) and (not name or name in node.classes)


class _Builder(HTMLParser):
    def __init__(self, html: str, closed: bool = False):
        super().__init__(convert_charrefs=False)
        self.html, self.closed = html, closed
        self.lines = [0, *(m.end() for m in re.finditer("\n", html))]
        self.root = Node("#root", 0, stop=len(html), inner_stop=len(html))
        self.open = [self.root]
        self.feed(html)
        self.close()
        for node in self.open:
            node.inner_stop = node.stop = len(html)

    def at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _close(self, depth: int, end: int, stop: int) -> None:
        """Closes the open elements from this depth on; the outermost of them ends at stop."""
        for node in self.open[depth:]:
            node.inner_stop = node.stop = end
        self.open[depth].stop = stop
        del self.open[depth:]

    def _last(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> int | None:
        """The depth of the outermost open element of these tags above the innermost holder."""
        found = None
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in within:
                break
            if self.open[depth].tag in tags:
                found = depth
        return found

    def handle_starttag(self, tag, attrs):
        at = self.at()
        if tag in _ENDS_P:
            depth = self._last(("p",), tuple(BREAKS - {"p"}) + ("td", "th", "article", "section"))
            if depth is not None:
                self._close(depth, at, at)
        if tag in _SIBLINGS:
            depth = self._last(_SIBLINGS[tag], _HOLDERS[tag])
            if depth is not None:
                self._close(depth, at, at)
        inner = at + len(self.get_starttag_text() or "")
        node = Node(tag, at, {k: v or "" for k, v in reversed(attrs)}, inner_start=inner, inner_stop=inner, stop=inner)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self.open) - 1, self.open[-1].inner_start, self.open[-1].inner_start)

    def handle_endtag(self, tag):
        depth = next((d for d in range(len(self.open) - 1, 0, -1) if self.open[d].tag == tag), None)
        if depth is not None:
            at = self.at()
            end = self.html.find(">", at)
            self._close(depth, at, len(self.html) if end < 0 else end + 1)

    def _text(self, text: str, size: int) -> None:
        at, into = self.at(), self.open[-1].children
        if into and not into[-1].tag and into[-1].stop == at:
            into[-1].text += text
            into[-1].stop = at + size
        else:
            into.append(Node("", at, text=text, stop=at + size))

    def handle_data(self, data):
        self._text(data, len(data))

    def _reference(self, size: int) -> None:
        from html import unescape

        ends = self.html.startswith(";", self.at() + size)
        source = self.html[self.at() : self.at() + size + ends]
        self._text(source if self.closed and not ends else unescape(source), size + ends)

    def handle_entityref(self, name):
        self._reference(len(name) + 1)

    def handle_charref(self, name):
        self._reference(len(name) + 2)


def tree(html: str, closed: bool = False) -> Node:
    """The page's root, whose children are what stands outermost. closed: only references that end with a semicolon are read;
    else those of the standard without one, too."""
    return _Builder(html, closed).root


#: Where a grid's place has its text from: a cell of its own, the cell to its left, the cell above.
OWN, LEFT, ABOVE = 0, 1, 2


def grid(table: Node) -> list[list[tuple[str, int]]]:
    """Rows of (text, origin) with cells put into every row and column that they span; rows of inner tables don't count."""
    rows: list[list[tuple[str, int]]] = []
    hanging: dict[int, list] = {}  # column -> [rows left, text]
    lines, stack = [], list(reversed(table.children))
    while stack:
        node = stack.pop()
        if node.tag == "tr":
            lines.append(node)
        elif node.tag != "table":
            stack.extend(reversed(node.children))

    def hang(out: list[tuple[str, int]]) -> None:
        while len(out) in hanging:
            k = len(out)
            hanging[k][0] -= 1
            out.append((hanging[k][1], ABOVE))
            if not hanging[k][0]:
                del hanging[k]

    for line in lines:
        out: list[tuple[str, int]] = []
        for cell in line.children:
            if cell.tag not in ("td", "th"):
                continue
            hang(out)
            wide, high = (max(1, int(cell.attributes[a])) if cell.attributes.get(a, "").isdigit() else 1 for a in ("colspan", "rowspan"))
            text = clean(cell.raw_text())
            for k in range(wide):
                at = len(out)
                if k and at in hanging:
                    del hanging[at]  # the wider cell covers what hangs from above
                out.append((text, LEFT if k else OWN))
                if high > 1:
                    hanging[at] = [high, text]
        for k in [k for k, x in hanging.items() if k < len(out) and x[0] > 1 and out[k][1] != ABOVE]:
            hanging[k][0] -= 1
        hang(out)
        while any(k > len(out) for k in hanging):  # a span further right, beyond a gap
            out.append(("", OWN))
            hang(out)
        rows.append(out)
    return rows


def outermost(root: Node, tag: str) -> list[Node]:
    """Elements of a tag that don't stand inside another of it, in document order."""
    out, stack = [], list(reversed(root.children))
    while stack:
        node = stack.pop()
        if node.tag == tag:
            out.append(node)
        else:
            stack.extend(reversed(node.children))
    return out


def clean(raw: str) -> str:
    """Lines as the markup breaks them, white space collapsed, without empty ones."""
    lines = (" ".join(x.replace("\xa0", " ").split()) for x in raw.split(BREAK))
    return "\n".join(x for x in lines if x)

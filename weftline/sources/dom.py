"""A small document tree over the standard library's tokenizer. Plain markup is read by one expression, from the first other token on the library's takes over.

Recovery rules, fixed here once: void elements have no content; a new p, li, option, tr, td or th closes an open one of its kind (td and th each other) up to the nearest enclosing container; a block closes an open p; an end tag without an open element is dropped; what is open at the end is closed there.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: What an opening tag closes, and what stops the search for it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
}
#: Text; a start tag with its attributes; an end tag; a comment or a document type. What the standard library might read otherwise (raw text with tags in it, values without quotes that have slashes) is none of them.
_WS = "[ \\t\\n\\r\\f]"
_ATTRIBUTE = rf"""{_WS}+([a-zA-Z_][-a-zA-Z0-9_]*)(?:=(?:"([^"]*)"|'([^']*)'|([-a-zA-Z0-9_.#%]+)(?=[ \t\n\r\f>])))?(?=[ \t\n\r\f/>])"""
_TOKEN = re.compile(rf"""([^<]+)|<(?:([a-zA-Z][a-zA-Z0-9]*)((?:{re.sub(r"[(](?=[^?])", "(?:", _ATTRIBUTE)})*){_WS}*/?>|/([a-zA-Z][a-zA-Z0-9]*){_WS}*>|!--(?!-?>)(?:[^-]|-(?!-))*-->|![dD][oO][cC][tT][yY][pP][eE]\b[^>\[]*>)""")
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_RAW = {name: re.compile(rf"([^<]*)</{name}{_WS}*>", re.I) for name in HTMLParser.CDATA_CONTENT_ELEMENTS}
_NO_ATTRIBUTES: dict[str, str] = {}


@lru_cache(4096)
def _attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; of repeated ones the first counts. Tags with the same text share them."""
    return {name.lower(): unescape(a or b or c) for name, a, b, c in reversed(_ATTRIBUTES.findall(f"{text}>"))}


@lru_cache(4096)
def _tag(inside: str) -> tuple[str | None, dict[str, str], str | None, bool] | None:
    """What is between < and the next >: tag, attributes, end tag, and whether it is empty; None if it isn't plain markup."""
    m = _TOKEN.fullmatch(f"<{inside}>")
    if m is None:
        return None
    _, tag, attributes, ended = m.groups()
    return tag and tag.lower(), _attributes(attributes) if attributes else _NO_ATTRIBUTES, ended and ended.lower(), inside[-1] == "/"


class Node:
    """An element: name, attributes, children (elements and strings), parent; and its place among all elements of the document in their order, up to which its own go on."""

    __slots__ = ("name", "attrs", "children", "parent", "document", "at", "end")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None, document: list[Node] | None = None) -> None:
        self.name, self.attrs, self.children, self.parent, self.document = name, attrs, [], parent, document
        self.at = self.end = -1

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order."""
        return iter(self.document[self.at + 1 : self.end])

    def find(self, *names: str, cls: str | None = None, where: Callable[[Node], bool] | None = None) -> list[Node]:
        below = self.document[self.at + 1 : self.end]
        if names:
            below = [n for n in below if n.name in names]
        return [n for n in below if (cls is None or cls in n.classes) and (where is None or where(n))] if cls is not None or where else below

    def first(self, *names: str, **how) -> Node | None:
        return next(iter(self.find(*names, **how)), None)

    def release(self) -> None:
        """Ends the use of a document: elements that hold one another would wait for the garbage collector."""
        for node in self.document:
            node.parent = node.document = None

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def strings(self) -> Iterator[str]:
        for c in self.children:
            if isinstance(c, Node):
                yield from c.strings()
            else:
                yield c

    def text(self) -> str:
        """The pieces of text, each trimmed, joined by one space."""
        return " ".join(s for s in (x.strip() for x in self.strings()) if s)

    def joined(self, sep: str = "") -> str:
        return sep.join(self.strings())

    def above(self, name: str, cls: str | None = None) -> Node | None:
        node = self.parent
        while node is not None and not (node.name == name and (cls is None or cls in node.classes)):
            node = node.parent
        return node

    def after(self, name: str, cls: str | None = None) -> list[Node]:
        """Later siblings of a name."""
        if self.parent is None:
            return []
        rest = self.parent.children[self.parent.children.index(self) + 1 :]
        return [c for c in rest if isinstance(c, Node) and c.name == name and (cls is None or cls in c.classes)]

    def own(self, *names: str) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.name in names]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.document: list[Node] = []
        self.root = self.at = Node("", _NO_ATTRIBUTES, None, self.document)

    def read(self, html: str) -> None:
        first, *pieces = html.split("<")
        at = len(first)
        if first:
            self.handle_data(unescape(first))
        for piece, following in zip(pieces, [*pieces[1:], ""]):
            inside, whole, text = piece.partition(">")
            found = _tag(inside) if whole else None
            if found is None:
                return self.read_from(html, at)
            tag, attributes, ended, empty = found
            raw = tag in _RAW and not empty
            if raw and not _RAW[tag].match(f"<{following}"):
                return self.read_from(html, at)
            if tag is not None:
                self.open(tag, attributes)
                if empty:
                    self.handle_endtag(tag)
            elif ended is not None:
                self.handle_endtag(ended)
            if text:
                self.handle_data(unescape(text) if "&" in text and not raw else text)
            at += len(piece) + 1
        self.close()

    def read_from(self, html: str, at: int) -> None:
        """The rest of a page, token by token: comments may hold markup, and values >."""
        token, n = _TOKEN.match, len(html)
        while at < n and (m := token(html, at)):
            text, tag, attributes, ended = m.groups()
            if text is not None:
                self.handle_data(unescape(text) if "&" in text else text)
            elif tag is not None:
                tag = tag.lower()
                empty = html[m.end() - 2] == "/"
                raw = None
                if tag in _RAW and not empty:
                    raw = _RAW[tag].match(html, m.end())
                    if raw is None:
                        break
                self.open(tag, _attributes(attributes) if attributes else _NO_ATTRIBUTES)
                if raw is not None:
                    if raw[1]:
                        self.handle_data(raw[1])
                    m = raw
                if empty or raw is not None:
                    self.handle_endtag(tag)
            elif ended is not None:
                self.handle_endtag(ended.lower())
            at = m.end()
        if at < n:
            self.feed(html[at:])
        self.close()

    def close_open(self, names: set[str], until: set[str]) -> None:
        node: Node | None = self.at
        last = None
        while node is not None and node.parent is not None and node.name not in until:
            if node.name in names:
                last = node
            node = node.parent
        if last is not None and last.parent is not None:
            self.at = last.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open(tag, {k: v or "" for k, v in reversed(attrs)})

    def open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in CLOSES:
            self.close_open(*CLOSES[tag])
        if tag in BLOCKS:
            self.close_open({"p"}, {"td", "th", "table", "div", "li", "button"})
        node = Node(tag, attrs, self.at, self.document)
        self.put(node)
        if tag not in VOID:
            self.at = node

    def put(self, node: Node) -> None:
        node.at = len(self.document)
        self.document.append(node)
        self.at.children.append(node)

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.name != tag:
            if node.name in {"table"} and tag not in {"body", "html", "div"}:
                return  # an end tag inside a table doesn't close what is around it
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.read(html or "")
    # an element's own are created while it is open, so they follow it without a gap
    for node in reversed(builder.document):
        node.end = max(node.end, node.at + 1)
        node.parent.end = max(node.parent.end, node.end)
    return builder.root


class _Links(_Builder):
    """Keeps no tree: only what is inside an open link, and what is open, is held. Each link is taken when the outermost one around it ends, in the order of the page."""

    def __init__(self, take: Callable[[Node], None]) -> None:
        super().__init__()
        self.take = take

    def settle(self) -> None:
        if self.document:
            node: Node | None = self.at
            while node is not None and node is not self.document[0]:
                node = node.parent
            if node is None:
                self.flush()

    def flush(self) -> None:
        for node in self.document:
            if node.name == "a":
                self.take(node)
        self.document.clear()

    def put(self, node: Node) -> None:
        self.settle()
        if self.document:
            super().put(node)
        elif node.name == "a":
            self.document.append(node)

    def handle_data(self, data: str) -> None:
        if self.document:
            super().handle_data(data)

    def handle_endtag(self, tag: str) -> None:
        super().handle_endtag(tag)
        self.settle()


def each_link(html: str | None, take: Callable[[Node], None]) -> None:
    """take(a) for each link of a page, as in parse(html).find("a"), without the tree of the page."""
    builder = _Links(take)
    builder.read(html or "")
    builder.flush()

"""HTML inside tasks, over the standard parser: a small element tree, and a walk that keeps no tree."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Elements whose start ends an open paragraph.
BLOCKS = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
# What JavaScript's trim removes.
JS_SPACE = "\t\n\x0b\x0c\r \xa0                　﻿"


class Element:
    __slots__ = ("tag", "attrs", "classes", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.classes = frozenset(attrs["class"].split()) if "class" in attrs else frozenset()
        self.children: list[Element | str] = []

    def below(self) -> Iterator[Element]:
        """Descendants in document order."""
        waiting = [c for c in reversed(self.children) if isinstance(c, Element)]
        while waiting:
            element = waiting.pop()
            yield element
            waiting.extend(c for c in reversed(element.children) if isinstance(c, Element))

    def text(self) -> str:
        """Text of the element without scripts and styles."""
        parts: list[str] = []
        waiting: list[Element | str] = [self]
        while waiting:
            node = waiting.pop()
            if isinstance(node, str):
                parts.append(node)
            elif node.tag not in ("script", "style"):
                waiting.extend(reversed(node.children))
        return "".join(parts)

    def fits(self, step: tuple[str, frozenset[str]]) -> bool:
        tag, classes = step
        return (not tag or tag == self.tag) and classes <= self.classes

    def find(self, selector: str) -> list[Element]:
        """Descendants that match a chain of steps separated by spaces."""
        *outer, last = steps(selector)
        found = []
        for element in self.below():
            if not element.fits(last):
                continue
            left, above = list(outer), element.parent
            while left and above is not None:
                if above.fits(left[-1]):
                    left.pop()
                above = above.parent
            if not left:
                found.append(element)
        return found


_known_steps: dict[str, list[tuple[str, frozenset[str]]]] = {}


def steps(selector: str) -> list[tuple[str, frozenset[str]]]:
    """Steps such as ``div``, ``.a.b`` or ``article.post`` as a tag and its classes."""
    if selector not in _known_steps:
        parts = [step.split(".") for step in selector.split()]
        _known_steps[selector] = [(tag, frozenset(classes)) for tag, *classes in parts]
    return _known_steps[selector]


def first_values(attrs: list[tuple[str, str | None]]) -> dict[str, str]:
    """Attributes by name; of repeated ones the first, without a value an empty text."""
    return {name: value or "" for name, value in reversed(attrs)}


def ended_by(tag: str) -> list[tuple[set[str], set[str]]]:
    """(tags, stops) that the start of ``tag`` ends: the nearest open one of the tags, unless a stop lies between."""
    out = [({"p"}, {"table", "td", "th", "button"})] if tag in BLOCKS else []
    if tag == "li":
        out.append(({"li"}, {"ul", "ol"}))
    elif tag in ("dt", "dd"):
        out.append(({"dt", "dd"}, {"dl"}))
    elif tag == "tr":
        out.append(({"tr"}, {"table"}))
    elif tag in ("td", "th"):
        out.append(({"td", "th"}, {"table", "tr"}))
    elif tag in ("a", "option"):
        out.append(({tag}, {"table", "select"}))
    return out


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.open = Element("", {}, None)

    def _close(self, tags: set[str], stops: set[str]) -> None:
        """End the nearest open element among ``tags`` unless one of ``stops`` lies between."""
        element = self.open
        while element.parent is not None and element.tag not in stops:
            if element.tag in tags:
                self.open = element.parent
                return
            element = element.parent

    def handle_starttag(self, tag, attrs):
        for tags, stops in ended_by(tag):
            self._close(tags, stops)
        element = Element(tag, first_values(attrs), self.open)
        self.open.children.append(element)
        if tag not in VOID:
            self.open = element

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close({tag}, set())

    def handle_data(self, data):
        self.open.children.append(data)


def parse(html: str) -> Element:
    return _fed(_Builder(), html).root


def _fed(parser: HTMLParser, html: str) -> HTMLParser:
    parser.feed(html.replace("\r\n", "\n").replace("\r", "\n"))
    parser.close()
    return parser


class Walk(HTMLParser):
    """Matches selectors while the parser runs, and keeps only the open elements.

    Of each open element it knows how many outer steps of each selector it and those around it
    fit. ``start`` is called for every element with the numbers of the selectors it fits; what
    it returns is kept while the element is open: a list (which gets the text inside, without
    scripts and styles) in ``texts``, and anything else in ``scopes``.
    """

    def __init__(self, selectors: list[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.chains = [steps(s) for s in selectors]
        self.open: list[tuple[str, tuple[int, ...], int, int, bool]] = [("", (0,) * len(selectors), 0, 0, False)]
        self.texts: list[list[str]] = []
        self.scopes: list[object] = []

    def start(self, tag: str, attrs: dict[str, str], fits: list[int]) -> list:
        raise NotImplementedError

    def _close(self, tags: set[str], stops: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag, _, texts, scopes, _ = self.open[depth]
            if tag in stops:
                return
            if tag in tags:
                del self.open[depth:], self.texts[texts:], self.scopes[scopes:]
                return

    def handle_starttag(self, tag, attrs):
        for tags, stops in ended_by(tag):
            self._close(tags, stops)
        named = first_values(attrs)
        classes = set(named["class"].split()) if "class" in named else ()
        _, around, _, _, silent = self.open[-1]
        fits, inner = [], None
        for i, chain in enumerate(self.chains):
            at = around[i]
            wanted, needed = chain[at]
            if (not wanted or wanted == tag) and (not needed or (classes and needed <= classes)):
                if at == len(chain) - 1:
                    fits.append(i)
                else:
                    inner = inner or list(around)
                    inner[i] = at + 1
        texts, scopes = len(self.texts), len(self.scopes)
        for kept in self.start(tag, named, fits):
            (self.texts if isinstance(kept, list) else self.scopes).append(kept)
        if tag in VOID:
            del self.texts[texts:], self.scopes[scopes:]
        else:
            self.open.append((tag, tuple(inner) if inner else around, texts, scopes, silent or tag in ("script", "style")))

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._close({tag}, set())

    def handle_data(self, data):
        if self.texts and not self.open[-1][4]:
            for text in self.texts:
                text.append(data)

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted."""
        return j

    def over(self, html: str) -> Walk:
        return _fed(self, html)

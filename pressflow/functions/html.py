"""Article pages read as a parser reads them.

A page is cut into tags, text and what is neither by one pattern that knows quoted attribute values,
comments and elements whose content is no markup. A stack of open elements then finds where each
element ends: by its end tag, by that of an element around it, by a start tag that implies its end,
or with the page. Elements and texts are numbered in page order, so what lies inside an element is
a range of numbers.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

# Names and values up to the closing bracket; quotes are quotes only where a value begins.
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+"""
_MARKUP = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>|<[!?/](?!\Z)[^>]*+(?:>|\Z)"
    r"|<[a-zA-Z].*", re.S)
_PARTS = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+""")

#: Elements without content, which no end tag follows.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup: what is shown of it is its text, or nothing.
PLAIN_TEXT, UNSHOWN = frozenset(["textarea", "title", "xmp"]), frozenset(
    ["script", "style", "template", "iframe", "noembed", "noframes"])
#: Elements that hold no place in a paragraph: their start tag closes it.
BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
#: A start tag ends the nearest open element of the first set, unless one of the second is nearer.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
#: Elements that a paragraph around them goes on after.
_CELLS = frozenset(["table", "td", "th", "caption"])
#: An end tag closes open elements up to its own, but none that stands higher than it.
_HEIGHT = {name: 1 for name in BLOCK - {"p"}} | {
    "td": 2, "th": 2, "caption": 2, "tr": 3, "tbody": 4, "thead": 4, "tfoot": 4, "table": 5, "body": 6, "html": 7}


@dataclass
class Element:
    """An element with the ranges of the elements and texts inside it; itself is not in its range."""

    name: str
    attributes: dict[str, str]
    first: int
    first_text: int
    last: int = 0
    last_text: int = 0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)

    def text(self, element: Element, separator: str) -> str:
        """Its text nodes, stripped, without the empty ones."""
        nodes = (t.strip() for t in self.texts[element.first_text:element.last_text])
        return separator.join(t for t in nodes if t)

    def inside(self, element: Element) -> Iterator[Element]:
        return iter(self.elements[element.first:element.last])


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for name, *values in _PARTS.findall(source):
        value = next(filter(None, values), "")
        found.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return found


def parse(source: str) -> Page:
    page, open_, at, n_open = Page(), [], 0, Counter()
    source = source.replace("\0", "")

    def text(value: str) -> None:
        if value:
            page.texts.append(html.unescape(value) if "&" in value else value)

    def close(down_to: int) -> None:
        while len(open_) > down_to:
            element = open_.pop()
            n_open[element.name] -= 1
            element.last, element.last_text = len(page.elements), len(page.texts)

    def nearest(names, stops) -> int | None:
        if any(n_open[name] for name in names):
            for k in range(len(open_) - 1, -1, -1):
                if open_[k].name in names:
                    return k
                if stops(open_[k].name):
                    return None
        return None

    while found := _MARKUP.search(source, at):
        text(source[at:found.start()])
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if found[1]:
            height = _HEIGHT.get(name, 0)
            own = nearest([name], lambda other: _HEIGHT.get(other, 0) > height)  # noqa: B023
            if own is not None:
                close(own)
            continue
        if name in BLOCK and (paragraph := nearest(["p"], _CELLS.__contains__)) is not None:
            close(paragraph)
        if name in IMPLIED_END and (before := nearest(
                IMPLIED_END[name][0], IMPLIED_END[name][1].__contains__)) is not None:
            close(before)
        element = Element(name, attributes(found[3]) if found[3] else {}, len(page.elements) + 1, len(page.texts))
        page.elements.append(element)
        open_.append(element)
        n_open[name] += 1
        if name in PLAIN_TEXT or name in UNSHOWN:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            if name in PLAIN_TEXT:
                text(source[at:end.start() if end else len(source)])
            at = end.start() if end else len(source)
        elif name in VOID:
            close(len(open_) - 1)
    text(source[at:])
    close(0)
    return page


@dataclass(frozen=True)
class Mark:
    """What tells an element apart: a whole attribute value, or one word of it."""

    attribute: str
    value: str
    word: bool = False

    def on(self, element: Element) -> bool:
        value = element.attributes.get(self.attribute)
        return value is not None and (self.value in value.split() if self.word else value == self.value)


def has_class(name: str) -> Mark:
    return Mark("class", name, word=True)


def has_value(attribute: str, value: str) -> Mark:
    return Mark(attribute, value)


def matching(elements, tag: str | None, mark: Mark | None) -> Iterator[Element]:
    return (e for e in elements if (tag is None or e.name == tag) and (mark is None or mark.on(e)))


def paragraphs(page: Page, blocks: list[Element]) -> list[str]:
    """Text of every paragraph inside one of the blocks, in page order."""
    inside = sorted({n for block in blocks for n in range(block.first, block.last)
                     if page.elements[n].name == "p"})
    return [page.text(page.elements[n], " ") for n in inside]

"""Feed documents read item by item, with recovery.

One pattern cuts a document into tags, text, CDATA sections and what is neither (comments,
processing instructions, declarations), so markup inside those is not taken for items. A stack of
open elements says which field a text belongs to. An end tag that fits no open element is passed
over, and one that fits an outer element closes those inside it, so an unclosed tag costs nothing
but itself.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARKUP = re.compile(
    r"<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)"
    r"""|<(/?)([^\s<>/!?=&;'"][^\s<>/]*+)((?>[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<![^>]*+(?:>|\Z)""", re.S)
_ENTITY = re.compile(r"&(?:(amp|lt|gt|quot|apos|nbsp)|#([0-9]{1,7})|#x([0-9A-Fa-f]{1,6}));")
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}

FIELDS = ("title", "link", "pubDate", "description", "dc:creator")
#: Why an item cannot be used.
CUT_OFF, UNREADABLE = "cut_off", "unreadable_item"


@dataclass
class Item:
    """The first element of each name inside an item, its text whole; and the first category."""

    start: int
    end: int = 0
    reason: str | None = None
    fields: dict[str, str] = field(default_factory=dict)


def _decoded(text: str) -> str:
    """XML's entities and the blank's; other ampersands stand for themselves."""
    def value(found: re.Match) -> str:
        if found[1]:
            return _NAMED[found[1]]
        code = int(found[2]) if found[2] else int(found[3], 16)
        return html.unescape(f"&#{code};") if 0 < code < 0x110000 else found[0]

    return _ENTITY.sub(value, text) if "&" in text else text


def scan(document: str | None) -> tuple[bool, list[Item]]:
    """Whether a document is a feed, and its items in order.

    An item ends with its end tag. One that another item or the end of the document cuts short is
    ``cut_off``; one without a title or link element is ``unreadable_item``.
    """
    is_feed, items, open_, at = False, [], [], 0
    #: Names being read in the current item with their depth; a field's first element counts.
    reading: list[tuple[str, int, list[str]]] = []
    item: Item | None = None

    def text(value: str) -> None:
        for _, _, parts in reading:
            parts.append(value)

    def close(depth: int) -> None:
        del open_[depth:]
        while reading and reading[-1][1] >= depth:
            name, _, parts = reading.pop()
            item.fields[name] = "".join(parts)

    def finish(end: int, reason: str | None) -> None:
        nonlocal item
        if item is not None:
            close(0)
            item.end, item.reason = end, reason or (None if {"title", "link"} & item.fields.keys() else UNREADABLE)
            items.append(item)
            item = None

    document = document or ""
    for found in _MARKUP.finditer(document):
        if reading:
            text(_decoded(document[at:found.start()]))
        at = found.end()
        if found[1] is not None:
            text(found[1])
            continue
        name = found[3]
        if name is None:
            continue
        is_feed = is_feed or name == "channel"
        if found[2]:
            if name == "item":
                finish(found.end(), None)
            elif item is not None and name in open_:
                close(len(open_) - 1 - open_[::-1].index(name))
        elif name == "item":
            finish(found.start(), CUT_OFF)
            item, open_ = Item(found.start()), []
            if found[4].endswith("/"):
                finish(found.end(), None)
        elif item is not None and not found[4].endswith("/"):
            if name in (*FIELDS, "category") and name not in item.fields and name not in [n for n, _, _ in reading]:
                reading.append((name, len(open_), []))
            open_.append(name)
        elif item is not None and name in (*FIELDS, "category"):
            item.fields.setdefault(name, "")
    finish(len(document), CUT_OFF)
    return is_feed, items

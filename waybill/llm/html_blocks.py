"""Cuts HTML into leaf blocks: runs of text between block-level tags, each with the open elements above it."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass

#: Elements that do not part text.
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup, and none of it is shown.
_RAW = frozenset("script style noscript template title textarea iframe noembed noframes xmp svg".split())
#: Opening one of these ends an open one of the group.
_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: And these end an open paragraph.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

#: An element that another one ends is looked for inside the innermost of these only.
_LISTS = ("table", "ul", "ol", "dl")

_TAG = re.compile(r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Za-z]+")


@dataclass(slots=True, eq=False)
class Element:
    """An open block-level element; those of a page share what is above them. What a labeller derives of it is kept in `marks`."""

    above: Element | None
    name: str
    named: tuple[str, ...]  # words of class, id and role
    attributes: str  # as they stand
    marks: int = -1


@dataclass
class Block:
    text: str
    leaf: Element | None  # the innermost one open
    linked: int  # code points inside links

    @property
    def path(self) -> list[tuple[str, tuple[str, ...], str]]:
        """Name, words and attributes of the open elements from the root on."""
        out, element = [], self.leaf
        while element:
            out.append((element.name, element.named, element.attributes))
            element = element.above
        return out[::-1]


class _Open:
    """The stack of open elements. For each name it knows the places, so that finding one costs nothing however deep the stack is."""

    def __init__(self) -> None:
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}

    def top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def push(self, name: str, attributes: str) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append(Element(self.top(), name, _names(attributes), attributes))

    def nearest(self, names: Iterable[str]) -> int:
        """Place of the innermost element with one of these names, or -1."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=-1)

    def cut(self, place: int) -> None:
        """Closes the element at a place and all inside it; every element is closed once."""
        while len(self.stack) > place:
            self.places[self.stack.pop().name].pop()


def _names(attributes: str) -> tuple[str, ...]:
    return tuple(w.lower() for m in _NAMED.finditer(attributes) for w in _PARTS.findall(m[1] or m[2] or m[3] or ""))


def leaf_blocks(page: str) -> list[Block]:
    """In page order, without empty ones. Character references are decoded and white space becomes single spaces; a tag that is cut off ends the page."""
    out: list[Block] = []
    opened = _Open()
    parts: list[str] = []
    links, in_links, at, n = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal in_links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, opened.top(), min(len(text), in_links)))
            parts.clear()
        in_links = 0

    def close(names: tuple[str, ...]) -> None:
        place = opened.nearest(names)
        if place >= 0 and (names == ("p",) or place > opened.nearest(_LISTS)):
            opened.cut(place)

    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            parts.append(page[at:end])
            if links:
                in_links += end - at
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if not m[4]:
            break
        if name in _RAW and not m[1]:
            if name != "svg":
                flush()
            if not m[3].rstrip().endswith("/"):
                over = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                at = over.end() if over else n
        elif name in _INLINE:
            links = max(0, links - 1) if name == "a" and m[1] else 1 if name == "a" else links
            if name == "br":
                parts.append(" ")
        else:
            flush()
            links = 0
            if m[1]:
                place = opened.nearest((name,))
                if place >= 0:
                    opened.cut(place)
            else:
                if name in _ENDS:
                    close(_ENDS[name])
                elif name in _ENDS_P and opened.stack and opened.stack[-1].name == "p":
                    opened.cut(len(opened.stack) - 1)
                if name not in _VOID and not m[3].endswith("/"):
                    opened.push(name, m[3])
    flush()
    return out

"""A small tolerant reader of HTML into a tree of elements, and its blocks of text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SPACE = re.compile(r"[\s/]*")
_ATTRIBUTE_NAME = re.compile(r"[^\s/>=][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_TOKEN = re.compile(r"[a-z]+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
INLINE = frozenset(
    "a abbr b bdi bdo cite code data dfn em font i img kbd label mark q s samp small span strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table select".split())
SCOPE = frozenset("article aside body div footer form header html main nav ol section table td th ul".split())


@dataclass
class Element:
    """An element with its attribute tokens; ``items`` are texts and elements in order."""

    tag: str
    tokens: frozenset[str] = frozenset()
    items: list = field(default_factory=list)

    def elements(self) -> list[Element]:
        return [x for x in self.items if isinstance(x, Element)]


def _tag_end(source: str, at: int) -> tuple[int, list[tuple[str, str]], bool]:
    """(place behind the tag, attributes, ends itself) of a tag whose name ends at ``at``.

    Quotes count only right after an equals sign. Place -1: the tag never closes. The place only moves forward.
    """
    found: list[tuple[str, str]] = []
    n, slash = len(source), False
    while True:
        space = _SPACE.match(source, at)
        slash = "/" in space[0]
        at = space.end()
        if at >= n:
            return -1, found, False
        if source[at] == ">":
            return at + 1, found, slash
        name = _ATTRIBUTE_NAME.match(source, at)
        if name is None:  # an equals sign where a name should be
            at += 1
            continue
        at, value = name.end(), ""
        equals = _EQUALS.match(source, at)
        if equals:
            at = equals.end()
            if at < n and source[at] in "\"'":
                end = source.find(source[at], at + 1)
                if end < 0:
                    return -1, found, False
                value, at = source[at + 1 : end], end + 1
            else:
                bare = _BARE.match(source, at)
                value, at = bare[0], bare.end()
                if value.endswith("/") and source[at : at + 1] == ">":
                    value, slash = value[:-1], True
                    found.append((name[0].lower(), value))
                    return at + 1, found, True
        found.append((name[0].lower(), value))


def parse(source: str) -> Element:
    """The tree of ``source``; end tags without a start are ignored, elements left open end with their parent.

    One forward pass: a tag, comment or declaration that never closes becomes text up to the next
    ``<`` and is not looked into again, and nothing behind it is taken to close it. Comments and declarations
    go. Scripts, styles and other raw elements are kept without content. Character references are
    decoded in each run of text on its own, so none is put together from two elements.
    """
    root = Element("#root")
    open_, at, n = _Open(root), 0, len(source)
    stack = open_.stack
    last = source.rfind(">")  # nothing closes behind it

    def text(start: int, end: int) -> None:
        if end > start:
            stack[-1].items.append(html.unescape(source[start:end]))

    raw_end: dict[str, int] = {}
    while at < n:
        start = source.find("<", at)
        if start < 0 or start > last:
            text(at, n)
            break
        text(at, start)
        at = start
        follows = source[start + 1 : start + 2]
        if follows == "!" and source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            at = end + 3 if end >= 0 else n  # an open comment hides the rest
            continue
        if follows in ("!", "?"):
            at = source.index(">", start) + 1
            continue
        closing = follows == "/"
        name = _NAME.match(source, start + 1 + closing)
        if name is None:
            at = start + 1
            stack[-1].items.append("<")
            continue
        if closing:
            end, attributes, itself = source.find(">", name.end()) + 1, [], False
        else:
            end, attributes, itself = _tag_end(source, name.end())
        if end <= 0:  # never closes: text as far as it was read, which is to the end
            text(start, n)
            break
        at, tag = end, name[0].lower()
        if closing:
            open_.close({tag})
            continue
        if tag in CLOSES_PARAGRAPH:
            open_.close({"p"}, SCOPE)
        if tag in SAME_KIND:
            open_.close(SAME_KIND[tag], LISTS)
        element = Element(tag, _tokens(attributes))
        stack[-1].items.append(element)
        if tag in RAW:
            if raw_end.get(tag, 0) is not None:
                found = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                raw_end[tag] = found and found.end()
            at = raw_end[tag] or n
        elif tag not in VOID and not itself:
            open_.push(element)
    return root


class _Open:
    """The open elements, with the places of each tag, so that looking for one costs the same at any depth."""

    def __init__(self, root: Element) -> None:
        self.stack = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def _last(self, tags: set[str] | frozenset[str]) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def close(self, tags: set[str], scope: frozenset[str] = frozenset()) -> None:
        """Close the innermost of ``tags`` and all within it, unless an element of ``scope`` stands between."""
        at = self._last(tags)
        if at and at >= self._last(scope):
            for element in self.stack[at:]:
                self.places[element.tag].pop()
            del self.stack[at:]


def _tokens(attributes: list[tuple[str, str]]) -> frozenset[str]:
    out: set[str] = set()
    for name, value in attributes:
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            out.update(_TOKEN.findall(value.lower()))
    return frozenset(out)


def squeezed(text: str) -> str:
    """White space as single spaces, trimmed."""
    return " ".join(text.split())


def clean(text: str) -> str:
    """Character references of raw text decoded, then ``squeezed``; what ``parse`` returns is decoded already."""
    return squeezed(html.unescape(text))

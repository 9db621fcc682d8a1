"""Pages as text blocks with the chain of elements they stand in; linear in the page.

A block is the text between two boundaries of block elements. Inline elements do not end it. Its
text is made of runs, the pieces between any two tags.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urlsplit

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style title textarea noscript template iframe svg xmp".split())
# Elements that end an open one of the same list, up to the nearest of the second list.
ENDS = {
    "p": (("p",), ()),
    "li": (("li", "p"), ("ul", "ol", "menu")),
    "dt": (("dt", "dd", "p"), ("dl",)),
    "dd": (("dt", "dd", "p"), ("dl",)),
    "tr": (("tr", "td", "th", "p"), ("table",)),
    "td": (("td", "th", "p"), ("tr", "table")),
    "th": (("td", "th", "p"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# Block elements before which an open paragraph ends.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol pre section table ul".split()
)
# Elements that hold no article text, wherever they stand.
OUTSIDE = frozenset(
    "nav footer aside form button select option fieldset dialog menu object applet canvas audio "
    "video map".split()
)
ARTICLE = frozenset(["article", "main"])
# Elements that are places in a page, not forms of text.
PLACES = frozenset("div section article main table center header".split())
ROLES_OUTSIDE = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split()
)
# Words of classes and ids that name what is not article text, and beginnings of such words.
NAMES = frozenset(
    "ad ads adv nav menu side header masthead banner notice alert gdpr consent privacy share sharing "
    "social related recommended recommendations popular trending teaser signup login search disqus "
    "reply replies respond response responses widget popup modal overlay toolbar topbar copyright "
    "legal disclaimer pager pagination paging hidden skip rail".split()
)
STARTS = (
    "advert", "adsense", "sponsor", "promo", "cookie", "comment", "breadcrumb", "sidebar", "footer",
    "navbar", "navig", "newsletter", "subscri", "menu",
)
# Words that name the place of the article; they outweigh the others but those of comments.
CONTENT = frozenset("content article main post entry story body page wrapper container layout".split())

_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_TAG_STOP = re.compile(r"[>\"']")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>\"']*)>")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|$)", re.I) for name in RAW}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Block:
    """``runs`` are ``(text, linked)`` pieces; ``path`` names the open elements from the outside."""

    path: tuple[str, ...]
    outside: str
    article: bool
    runs: list = field(default_factory=list)


@dataclass
class Page:
    """``tokens`` are ``(path, kind, text)`` in page order: ``<`` opens, ``>`` closes, ``t`` is a run."""

    blocks: list = field(default_factory=list)
    tokens: list = field(default_factory=list)


def host_of(url: str | None) -> str:
    """Lower-case host of an address, empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").rstrip(".")
    except ValueError:
        return ""


def squeeze(text: str) -> str:
    return " ".join(text.split())


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(source):
        value = match[2] or ""
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(match[1].lower(), value)
    return found


def _judge(name: str, attributes: dict[str, str], in_article: bool) -> str:
    """Why an element is no article text: ``tag``, ``form`` or ``name``; empty if it may be."""
    if name in OUTSIDE:
        return "form" if name in ("form", "fieldset") else "tag"
    if name == "header" and not in_article:
        return "tag"
    role = attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    if role in ROLES_OUTSIDE or "hidden" in attributes or "display:none" in style:
        return "tag"
    named = [p.lower() for k in ("class", "id") for p in _PART.findall(attributes.get(k, ""))]
    if any(p.startswith(("comment", "disqus")) for p in named) and name not in ("body", "html"):
        return "name"
    if name in ARTICLE or name in ("body", "html") or CONTENT.intersection(named):
        return ""
    if in_article and "header" in named:
        return ""
    outside = any(p in NAMES or p.startswith(STARTS) for p in named)
    return "name" if outside else ""


@lru_cache(1 << 12)
def _element(name: str, source: str, in_article: bool) -> tuple[str, str, bool]:
    """Why an element is outside, its label, and whether it is unnamed and told apart by order.

    The label has classes and id, without numbers that change from page to page.
    """
    attributes = _attributes(source) if source else {}
    why = _judge(name, attributes, in_article)
    classes = sorted({re.sub(r"\d+", "", c) for c in attributes.get("class", "").split()} - {""})
    own = re.sub(r"\d+", "", attributes.get("id", ""))
    label = name + "".join(f".{c}" for c in classes) + (f"#{own}" if own else "")
    return why, label, label == name and name in PLACES


def parse(source: str) -> Page:
    """Blocks and tokens of a page; comments, raw elements and the head have no text."""
    page = Page()
    # Open block elements: name, unnamed elements in it, why outside, in an article.
    stack: list[tuple[str, dict, str, bool]] = []
    roots: dict[str, int] = {}
    path: tuple[str, ...] = ()
    block: Block | None = None
    links = 0
    in_head = False
    no_quote = set()
    at, size = 0, len(source)

    def outside() -> str:
        return stack[-1][2] if stack else ""

    def close(count: int) -> None:
        """Close the innermost ``count`` elements."""
        nonlocal path, block, in_head
        for _ in range(count):
            page.tokens.append((path, ">", ""))
            if stack.pop()[0] == "head":
                in_head = False
            path = path[:-1]
        block = None

    def end(names: tuple, barriers: tuple) -> None:
        """Close an open element of ``names`` that a new one ends."""
        for depth, (name, *_) in enumerate(reversed(stack), 1):
            if name in barriers:
                return
            if name in names:
                close(depth)
                return end(names, barriers)
            if name not in INLINE and name != "p" and not barriers:
                return

    def text(piece: str) -> None:
        nonlocal block
        if not piece or in_head:
            return
        if "&" in piece:
            piece = html.unescape(piece)
        if block is None:
            if not piece.strip():
                return
            block = Block(path, outside(), bool(stack) and stack[-1][3])
            page.blocks.append(block)
        block.runs.append((piece, links > 0))
        told = squeeze(piece)
        if told:
            page.tokens.append((path, "t", told))

    while at < size:
        start = source.find("<", at)
        if start < 0:
            text(source[at:])
            break
        follow = source[start + 1 : start + 2]
        if not (follow.isalpha() and follow.isascii()) and follow not in ("/", "!", "?"):
            text(source[at : start + 1])
            at = start + 1
            continue
        text(source[at:start])
        if source.startswith("<!--", start):
            stop = source.find("-->", start + 4)
            at = size if stop < 0 else stop + 3
            continue
        match = _TAG.match(source, start)
        if match is not None:
            closing, name, inner = bool(match[1]), match[2].lower(), match[3]
            at = match.end()
        else:
            # The end of the tag, outside of quotes; an unclosed quote is an ordinary character.
            stop = start + 1
            while True:
                match = _TAG_STOP.search(source, stop)
                if match is None:
                    stop = size
                    break
                stop = match.end()
                if match[0] == ">":
                    break
                if match[0] not in no_quote:
                    other = source.find(match[0], stop)
                    if other < 0:
                        no_quote.add(match[0])
                    else:
                        stop = other + 1
            inner = source[start + 1 : stop - 1]
            at = stop
            closing = inner.startswith("/")
            match = _NAME.match(inner, 1 if closing else 0)
            if match is None:
                continue
            name, inner = match[0].lower(), inner[match.end() :]
        if closing:
            if name == "a":
                links = max(0, links - 1)
            depth = next((d for d, s in enumerate(reversed(stack), 1) if s[0] == name), 0)
            if depth:
                close(depth)
            elif name not in INLINE:
                block = None
            continue
        if name in RAW:
            stop = _RAW_END[name].search(source, at)
            at = size if stop is None else stop.start()
            continue
        if name == "br":
            text(" ")
        if name == "a":
            links = 1  # links do not nest
        in_article = bool(stack) and stack[-1][3]
        why, label, unnamed = _element(name, inner, in_article)
        why = outside() or why
        if name in VOID or (name in INLINE and why == outside()):
            if name not in INLINE:
                block = None
            continue
        if name in ENDS_P:
            end(("p",), ())
        if name in ENDS:
            end(*ENDS[name])
        links = 0 if name not in INLINE else links
        if unnamed:
            earlier = stack[-1][1] if stack else roots
            earlier[name] = number = earlier.get(name, 0) + 1
            label = name if number == 1 else f"{name}.{number}"
        in_head = in_head or name == "head"
        stack.append((name, {}, why, not why and (in_article or name in ARTICLE)))
        path = (*path, label)
        page.tokens.append((path, "<", ""))
        block = None
    return page

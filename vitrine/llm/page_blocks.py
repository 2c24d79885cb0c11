"""Text blocks of a web page: the leaves of its block-level elements, with what surrounds them."""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from typing import Any

# How HTML elements are laid out and closed.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = ("script", "style", "template", "noscript", "title", "svg", "iframe", "object", "math", "canvas", "audio",
          "video", "textarea", "select")
CLOSED_BY = {
    "p": frozenset("p".split()), "li": frozenset("li".split()), "dt": frozenset("dt dd".split()),
    "dd": frozenset("dt dd".split()), "tr": frozenset("tr".split()), "td": frozenset("td th".split()),
    "th": frozenset("td th".split()), "option": frozenset("option".split()),
}
CLOSES_P = frozenset((
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul").split())
SCOPES = frozenset("ul ol dl table body html".split())

_tag = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_attributes = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_named = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_tokens = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+").findall
#: Without an end tag these hide the rest of the page, as in browsers; the others hide nothing.
HIDE_REST = frozenset("script style textarea title".split())
#: Characters read in vain for attributes whose quotes never close, in sizes of the page; beyond that tags end at the next sign.
READ_IN_VAIN = 8
_ends = {name: re.compile(rf"</{name}\s*>", re.I) for name in UNSEEN}


class Block:
    """One run of text, the tag of its element, and the state of the elements around it."""

    __slots__ = ("text", "tag", "state", "linked")

    def __init__(self, text: str, tag: str, state: Any, linked: int):
        self.text, self.tag, self.state, self.linked = text, tag, state, linked


def read_blocks(page: str | None, enter: Callable[[Any, str, tuple], Any]) -> list[Block]:
    """The blocks in page order; ``linked`` counts characters in links.

    ``enter(state, tag, name words)`` gives the state inside an element from
    the state around it; the state outside of all is ``None``.  Character references are decoded and white space becomes one space.
    Markup that is not closed is read as browsers do, in time linear in the page.
    """
    if not page:
        return []
    blocks: list[Block] = []
    stack: list[tuple[str, Any]] = []
    opened: dict[str, list[int]] = {}  # of each tag, the places of its open elements in the stack
    unended: set[str] = set()
    pieces: list[str] = []
    linked_pieces: list[str] = []
    in_link = 0
    at, size, in_vain = 0, len(page), 0
    tag, state = "none", None

    def flush() -> None:
        nonlocal pieces, linked_pieces
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(text, tag, state, len(" ".join(html.unescape("".join(linked_pieces)).split()))))
            pieces, linked_pieces = [], []

    def close(name: str) -> None:
        """Close the innermost element of that name and all inside it."""
        nonlocal tag, state
        while stack:
            top = stack.pop()[0]
            opened[top].pop()
            if top == name:
                break
        tag, state = stack[-1] if stack else ("none", None)

    while at < size:
        next_tag = page.find("<", at)
        if next_tag < 0:
            next_tag = size
        if next_tag > at:
            pieces.append(page[at:next_tag])
            if in_link:
                linked_pieces.append(page[at:next_tag])
        if next_tag == size:
            break
        found = _tag.match(page, next_tag + 1)
        if not found:
            if page.startswith("<!--", next_tag):
                end = page.find("-->", next_tag + 4)
                at = size if end < 0 else end + 3
            elif page.startswith(("<!", "<?", "</"), next_tag):
                end = page.find(">", next_tag)
                at = size if end < 0 else end + 1
            else:  # a bare sign
                pieces.append("<")
                at = next_tag + 1
            continue
        rest = _attributes.match(page, found.end()) if in_vain <= READ_IN_VAIN * size else None
        if rest:
            at = rest.end()
        else:  # a quote that is never closed
            in_vain += size - found.end()
            end = page.find(">", found.end())
            at = size if end < 0 else end + 1
        ending, name = found[1], found[2].lower()

        if name in INLINE:
            if name == "a":
                in_link = 0 if ending else 1
            elif name == "br":
                pieces.append(" ")
            continue
        if not ending and name in _ends:
            if name in ("svg", "math") and page.endswith("/>", found.end(), at):
                continue  # closed at once
            end = None if name in unended else _ends[name].search(page, at)
            if end:
                at = end.end()
            elif name in HIDE_REST:
                at = size
            else:
                unended.add(name)
            if name not in ("script", "style", "noscript", "template"):
                pieces.append(" ")
            continue
        flush()
        in_link = 0
        if name in VOID:
            continue
        if ending:
            if opened.get(name):
                close(name)
            continue
        if name in CLOSES_P and opened.get("p"):
            close("p")
        if name in CLOSED_BY:
            _, other = max(((opened[t][-1], t) for t in (*CLOSED_BY[name], *SCOPES) if opened.get(t)), default=(0, ""))
            if other in CLOSED_BY[name]:
                close(other)
        names: tuple = ()
        if at - found.end() > 4:
            named = _named.findall(page, found.end(), at)
            if named:
                names = tuple(t.lower() for _, value in named for t in _tokens(value))
        tag, state = name, enter(state, name, names)
        opened.setdefault(name, []).append(len(stack))
        stack.append((tag, state))
    flush()
    return blocks

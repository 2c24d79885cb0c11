"""Web pages as arrays of nodes, and selectors as expressions over them.

A page is read once, by an Arrow UDF, into an array of element nodes in document
order.  ``idx`` numbers elements and text pieces together, ``last`` is the
highest number inside an element, so "is inside" is a range test.  Selectors are
higher-order functions over that array, written as SQL text that ``F.expr``
takes (hundreds of selectors then cost one driver call per column, not one per
operator): no shuffle and no second parse.

Give :func:`parse_nodes` the selectors a query uses and only the nodes these can
match leave Python; a page of thousands of nodes shrinks to a few dozen.  Its
first node then also carries an index: for each of these selectors the places
of the nodes that satisfy it, ancestors included.  Under a :class:`PageNodes`
column, selecting is one look at that index instead of a walk over the nodes.
"""

from __future__ import annotations

import gc
import re
import sys
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from html import unescape
from itertools import accumulate, chain, count

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Executors need no copy of this package: the reader travels with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("text", T.StringType())])
NODE = T.StructType([
    T.StructField("idx", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("cls", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("is_first", T.BooleanType()),
    T.StructField("is_last", T.BooleanType()),
    T.StructField("texts", T.ArrayType(TEXT)),
    T.StructField("inner", TEXT),
    T.StructField("around", T.ArrayType(TEXT)),
    T.StructField("alltext", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("span", T.IntegerType()),
    T.StructField("hits", T.MapType(T.IntegerType(), T.ArrayType(T.IntegerType()))),
])
NODES = T.ArrayType(NODE)

# --------------------------------------------------------------------------
# Selectors
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Sel:
    """One selector: every given part must hold.

    ``Sel("a", cls="next")`` is ``a.next``; ``attr="x"`` asks for the attribute,
    ``eq`` / ``has`` for its value or a part of it; ``cls_has`` for a part of
    the class text; ``within`` for an ancestor; ``contains`` for text inside.
    """

    tag: str | None = None
    cls: str | None = None
    cls_has: tuple[str, ...] = ()
    attr: str | None = None
    eq: str | None = None
    has: str | None = None
    is_first: bool = False
    is_last: bool = False
    contains: str | None = None
    within: "Sel | tuple[Sel, ...] | None" = None

    def test(self, n: str) -> str:
        """SQL condition of the selector, without its ancestor part, for node ``n``."""
        tests = []
        if self.tag:
            tests.append(f"{n}.tag = {quoted(self.tag)}")
        if self.cls:
            tests.append(f"contains({n}.cls, {quoted(f' {self.cls} ')})")
        tests += [f"contains({n}.cls, {quoted(part)})" for part in self.cls_has]
        if self.attr:
            value = f"{n}.attrs[{quoted(self.attr)}]"
            if self.eq is not None:
                tests.append(f"{value} = {quoted(self.eq)}")
            elif self.has is not None:
                tests.append(f"contains({value}, {quoted(self.has)})")
            else:
                tests.append(f"{value} IS NOT NULL")
        if self.is_first:
            tests.append(f"{n}.is_first")
        if self.is_last:
            tests.append(f"{n}.is_last")
        if self.contains:
            tests.append(f"contains({n}.alltext, {quoted(self.contains)})")
        return " AND ".join(tests) or "true"

    def above(self) -> tuple["Sel", ...]:
        """The ancestors it names, any of which is enough."""
        return self.within if isinstance(self.within, tuple) else (self.within,) if self.within else ()

    def parts(self) -> list["Sel"]:
        """This selector and the ancestors it names."""
        return [self] + [p for a in self.above() for p in a.parts()]

    def key(self) -> int:
        """Number of the selector in the index of a page."""
        return zlib.crc32(repr(self).encode()) & 0x7FFFFFFF


Selectors = Sel | Iterable[Sel]


_names = count()


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fresh() -> str:
    """A name for a lambda variable that no enclosing lambda uses."""
    return f"v{next(_names)}"


def each(values: str, body: Callable[[str], str]) -> str:
    v = fresh()
    return f"transform({values}, {v} -> {body(v)})"


def where(values: str, test: Callable[[str], str]) -> str:
    v = fresh()
    return f"filter({values}, {v} -> {test(v)})"


def any_of(values: str, test: Callable[[str], str]) -> str:
    v = fresh()
    return f"exists({values}, {v} -> {test(v)})"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it inside ``body``."""
    return f"element_at({each(f'array({value})', body)}, 1)"


def matches(n: str, sels: Selectors) -> str:
    """Condition that the node matches any of the selectors, ancestors aside."""
    sels = [sels] if isinstance(sels, Sel) else list(sels)
    return "(" + " OR ".join(f"({s.test(n)})" for s in sels) + ")"


def inside(n: str, ancestor: str) -> str:
    return f"({n}.idx > {ancestor}.idx AND {n}.idx <= {ancestor}.last)"


#: Key of the empty list that stands in the index of every page.
_NOWHERE = -1


class PageNodes(str):
    """Name of a column that holds whole pages, read with the selectors that are asked of it.

    A selector that was not given to :func:`parse_nodes` finds nothing.
    """

    def hits(self, sel: Sel) -> str:
        return f"try_element_at({self}[0].hits, {sel.key()})"

    def places(self, sels: list[Sel]) -> str:
        """Places of the nodes that match any of the selectors, in document order."""
        none = f"{self}[0].hits[{_NOWHERE}]"
        found = [f"coalesce({self.hits(s)}, {none})" for s in sels]
        return found[0] if len(found) == 1 else f"array_sort(array_distinct(concat({', '.join(found)})))"


def select(nodes: str, sels: Selectors) -> str:
    """Nodes that match any of the selectors, in document order."""
    sels = [sels] if isinstance(sels, Sel) else list(sels)
    if isinstance(nodes, PageNodes):
        return each(nodes.places(sels), lambda i: f"{nodes}[{i}]")
    return _select(nodes, sels)


def box(nodes: str, n: str) -> str:
    """The node ``n`` of the page and all nodes inside it."""
    return f"slice({nodes}, {n}.place + 1, {n}.span)"


def _select(nodes: str, sels: list[Sel]) -> str:
    above = {s.within for s in sels}
    if above == {None}:
        return where(nodes, lambda n: matches(n, sels))
    if len(above) > 1:
        found = ", ".join(each(select(nodes, s), lambda n: f"{n}.idx") for s in sels)
        return let(f"concat({found})", lambda ids: where(nodes, lambda n: f"array_contains({ids}, {n}.idx)"))
    # Roots first: most pages have none, and then no node is looked at.
    return let(select(nodes, above.pop()), lambda roots: (
        f"CASE WHEN size({roots}) = 0 THEN slice({nodes}, 1, 0) ELSE "
        + where(nodes, lambda n: f"{matches(n, sels)} AND " + any_of(roots, lambda r: inside(n, r)))
        + " END"))


def exists(nodes: str, sels: Selectors) -> str:
    sels = [sels] if isinstance(sels, Sel) else list(sels)
    if isinstance(nodes, PageNodes):
        return "(" + " OR ".join(f"{nodes.hits(s)} IS NOT NULL" for s in sels) + ")"
    if any(s.within for s in sels):
        return f"(size({_select(nodes, sels)}) > 0)"
    return any_of(nodes, lambda n: matches(n, sels))


def first_text(found: str) -> str:
    """First text piece directly inside any of the found nodes."""
    return f"array_min(flatten({each(found, lambda n: f'{n}.texts')})).text"


def all_texts(found: str) -> str:
    """All text pieces directly inside the found nodes, in document order."""
    pieces = f"array_sort(flatten({each(found, lambda n: f'{n}.texts')}))"
    return each(pieces, lambda piece: f"{piece}.text")


def first_inner_text(found: str) -> str:
    """First text piece at any depth inside the found nodes."""
    return f"array_min({each(found, lambda n: f'{n}.inner')}).text"


def all_attrs(found: str, name: str) -> str:
    return where(each(found, lambda n: f"{n}.attrs[{quoted(name)}]"), lambda v: f"{v} IS NOT NULL")


def first_attr(found: str, name: str) -> str:
    return f"try_element_at({all_attrs(found, name)}, 1)"


def outer_html(n: str, html: str) -> str:
    """Source text of one node."""
    return f"substr({html}, {n}.start + 1, {n}.stop - {n}.start)"


def first_outer_or_text(found_outer: str, found_text: str, html: str) -> str:
    """First in document order of: whole source of the first kind, text of the second."""
    head = each(f"slice({found_outer}, 1, 1)",
                lambda n: f"named_struct('pos', {n}.idx, 'text', {outer_html(n, html)})")
    return f"array_min(concat({head}, flatten({each(found_text, lambda n: f'{n}.texts')}))).text"


def first_of(*values: str) -> str:
    """Ordered fallback: the first value that is neither null nor empty."""
    return "coalesce(" + ", ".join(f"nullif({v}, '')" for v in values) + ")"


def first_list(*lists: str) -> str:
    """Ordered fallback over arrays: the first that has entries."""
    first, *rest = lists
    if not rest:
        return first
    return let(first, lambda got: f"CASE WHEN size({got}) > 0 THEN {got} ELSE {first_list(*rest)} END")


# --------------------------------------------------------------------------
# Page reading
# --------------------------------------------------------------------------

# Fixed values of HTML: elements without content, elements whose content is
# plain text, and which open elements a start tag closes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_OPAQUE = frozenset(("script", "style"))
_BLOCKS = frozenset(
    "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "optgroup": ("option", "optgroup"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th", "thead", "tbody", "tfoot"), "tbody": ("tr", "td", "th", "thead", "tbody", "tfoot"),
    "tfoot": ("tr", "td", "th", "thead", "tbody", "tfoot"), "body": ("head",), "a": ("a",), "button": ("button",),
}
_CLOSES |= {tag: ("p",) for tag in _BLOCKS}
_FENCES = {
    "li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
    "option": frozenset(("select",)), "optgroup": frozenset(("select",)),
}
_TABLE_FENCE = frozenset(("table",))
_BLOCK_FENCE = frozenset("div td th li dd dt section article nav main aside header footer form body table".split())
_FENCES |= {"a": _BLOCK_FENCE, "button": _BLOCK_FENCE}
_NO_BLANK_TEXT = frozenset(("#page", "html", "head"))

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>
      |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)
       (?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)>""",
    re.S | re.X,
)
# A whole tag whose quotes all close inside it, so that it is read in the same way whatever follows.
_PLAIN_TAG = re.compile(
    r"""(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>"'=<]*+)
        (?P<attrs>(?:[\s/]++|[^\s/>"'=<]++(?:\s*+=\s*+(?:"[^">]*+"|'[^'>]*+'|[^\s>"']++))?+)*+)""",
    re.X,
)
_OPAQUE_END = {tag: re.compile(rf"</{tag}", re.I) for tag in _OPAQUE}
_ATTR = re.compile(
    r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""", re.S
)


def _attrs(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(source):
        value = double or single or bare
        out.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return out


class _Node:
    __slots__ = ("idx", "parent", "last", "tag", "attrs", "cls", "first", "kid", "pieces", "is_last",
                 "start", "stop", "inner", "deep", "near", "met", "over", "base")

    wanted = True

    def __init__(self, idx, parent, tag, attrs, cls, start, near, base):
        self.idx = self.last = idx
        self.parent, self.tag, self.attrs, self.cls = parent, tag, attrs, cls
        self.near = near  # the nearest kept ancestor
        self.base = base  # selectors that its tag and attributes satisfy
        self.start = self.stop = start
        self.pieces = []
        self.first = self.is_last = True
        self.kid = self.inner = self.deep = None


class _Open:
    """An element that no selector can match: what its open descendants need to know of it."""

    __slots__ = ("idx", "parent", "tag", "near", "pieces", "kid", "inner", "last", "stop")

    wanted = False
    deep = None

    def __init__(self, idx, parent, tag, near):
        self.idx, self.parent, self.tag, self.near = idx, parent, tag, near
        self.pieces = []
        self.kid = self.inner = None


class _Passed:
    """Stands for the latest child of a node where that child is not wanted."""

    is_last = False


_PASSED = _Passed()


class _StartTags:
    """Reads start tags: whether the node may be wanted, its attributes, class text and selectors.

    Pages of one site repeat their tags, so short ones are read once and kept.
    """

    _HELD, _SHORT = 10_000, 200

    def __init__(self, keep: "_Keep | None", index: "_Index | None"):
        self.keep, self.index = keep, index
        self.known: dict[tuple[str, str], tuple[bool, dict[str, str], str, int]] = {}
        self.plain: dict[str, tuple] = {}

    def read(self, tag: str, source: str) -> tuple[bool, dict[str, str], str, int]:
        found = self.known.get((tag, source))
        if found is None:
            found = self._read(tag, source)
            if len(source) <= self._SHORT:
                if len(self.known) >= self._HELD:
                    self.known.clear()
                self.known[tag, source] = found
        return found

    def _read(self, tag: str, source: str) -> tuple[bool, dict[str, str], str, int]:
        wanted = self.keep is None or self.keep.may_want(tag, source)
        attrs = _attrs(source) if wanted and source else {}
        words = attrs.get("class")
        cls = f" {' '.join(words.split())} " if words else ""
        return wanted, attrs, cls, self.index.of_tag(tag, cls, attrs) if wanted and self.index else 0

    def whole(self, source: str) -> tuple[str, str, tuple[bool, dict[str, str], str, int] | None] | None:
        """Name, mark of an end tag and what :meth:`read` gives, of all that stands between ``<`` and ``>``.

        None if what follows could change how it is read.
        """
        m = _PLAIN_TAG.fullmatch(source)
        if m is None:
            return None
        tag, end, attrs = m.group("tag", "end", "attrs")
        tag = tag.lower()
        found = tag, end, None if end else self._read(tag, attrs)
        if len(self.plain) >= self._HELD:
            self.plain.clear()
        self.plain[source] = found
        return found


def _read_page(html: str, full_text: frozenset[str], start_tags: _StartTags = _StartTags(None, None)) -> list[_Node]:
    """Element nodes of one page in document order; the first is the page itself.

    Only nodes that may be wanted are kept and have their attributes read; of the others, what their open descendants need
    to know.  The places of the open elements are kept by tag, so a tag finds its partner
    without a walk, however many elements a broken page leaves open.  A short tag that was met before is known by its
    text; the others are looked at by pattern.
    """
    index = start_tags.index
    root = _Node(0, None, "#page", {}, "", 0, None, index.of_tag("#page", "", {}) if index else 0)
    nodes, stack, deep, count = [root], [root], [], 1
    open_at: dict[str, list[int]] = {}
    at, size, pending = 0, len(html), 0
    search, find, longest = _TOKEN.search, html.find, start_tags._SHORT
    known, whole, read_tag = start_tags.plain.get, start_tags.whole, start_tags.read

    while True:
        start = find("<", at)
        tag, done = None, start < 0
        if done:
            start = size
        else:
            stop = find(">", start, start + longest)
            found = None
            if stop > 0:
                source = html[start + 1:stop]
                found = known(source) or whole(source)
            if found is not None:
                at = stop + 1
                tag, end, read = found
            else:
                m = search(html, start)
                if m is None:
                    start, done = size, True
                else:
                    start, at = m.span()
                    tag, end, source = m.group("tag", "end", "attrs")
                    if tag is not None:
                        tag = tag.lower()
                        read = None if end else read_tag(tag, source)
        if start > pending:
            top = stack[-1]
            piece = html[pending:start]
            if top.tag not in _NO_BLANK_TEXT or not piece.isspace():
                entry = (count, unescape(piece) if "&" in piece and top.tag not in _OPAQUE else piece)
                count += 1
                top.pieces.append(entry)
                n = top  # the first text of a node is also that of its open ancestors
                while n is not None and n.inner is None:
                    n.inner = entry
                    n = n.parent
                for n in deep:
                    n.deep.append(entry[1])
        if done:
            break
        pending = at
        if tag is None:  # comment or declaration: a break between text pieces
            continue
        shut, stop = None, start
        if end:
            places = open_at.get(tag)
            if not places:
                continue
            shut = places[-1]
            n = stack[shut]
            n.stop = at
            if shut == len(stack) - 1:  # the innermost element, as in a page without faults
                n.last, n.kid = count - 1, None
                if n.deep is not None:
                    deep.pop()
                del stack[shut], places[-1]
                continue
        else:
            closed = _CLOSES.get(tag)
            over = [open_at[t] for t in closed if open_at.get(t)] if closed else None
            if over:
                fences = _FENCES.get(tag) or (_BLOCK_FENCE if tag in _BLOCKS else _TABLE_FENCE)
                fence = max((open_at[t][-1] for t in fences if open_at.get(t)), default=0)
                shut = min((places[bisect_right(places, fence)] for places in over if places[-1] > fence), default=None)
        if shut is not None:
            while len(stack) > shut:
                n = stack.pop()
                n.last, n.kid = count - 1, None  # without links down, pages free themselves
                if n.wanted and n.stop == n.start:
                    n.stop = stop
                if n.deep is not None:
                    deep.pop()
                open_at[n.tag].pop()
        if end:
            continue

        parent = stack[-1]
        wanted, attrs, cls, base = read
        near = parent if parent.wanted else parent.near
        if wanted:
            n = _Node(count, parent, tag, attrs, cls, start, near, base)
            nodes.append(n)
            if parent.kid is not None:
                parent.kid.is_last = n.first = False
            parent.kid = n
        else:
            if parent.kid is not None:
                parent.kid.is_last = False
            parent.kid = _PASSED
        count += 1
        if tag in _VOID:
            if wanted:
                n.stop = at
            continue
        if not wanted:
            n = _Open(count - 1, parent, tag, near)
        places = open_at.get(tag)
        if places is None:
            open_at[tag] = [len(stack)]
        else:
            places.append(len(stack))
        stack.append(n)
        if wanted and tag in full_text:
            n.deep = []
            deep.append(n)
        if tag in _OPAQUE:
            close = _OPAQUE_END[tag].search(html, at)
            at = close.start() if close else size
    for n in stack:
        n.last, n.stop, n.kid = count - 1, size, None
    return nodes


@dataclass(frozen=True)
class _Keep:
    """Which nodes any of the used selectors could match."""

    tags: frozenset[str]
    source: re.Pattern | None

    @staticmethod
    def of(sels: Iterable[Sel]) -> "_Keep | None":
        tags, words = set(), set()
        for part in (p for s in sels for p in s.parts()):
            if part.cls or part.cls_has:
                words.add(part.cls or part.cls_has[0])
            elif part.attr:
                words.add(part.attr)
            elif part.tag:
                tags.add(part.tag)
            else:
                return None
        # Words are looked for in the unread attribute text, which holds them
        # literally unless an entity hides them.  A word that contains another
        # one needs no search of its own.
        words = {w.lower() for w in words}
        shortest = [w for w in words if not any(o != w and o in w for o in words)]
        pattern = re.compile("|".join(map(re.escape, sorted(shortest))) + "|&") if words else None
        return _Keep(frozenset(tags), pattern)

    def may_want(self, tag: str, source: str) -> bool:
        return tag in self.tags or bool(source and self.source and self.source.search(source.lower()))


class _Index:
    """Finds the selectors that each node of a page satisfies; one bit for each selector.

    Tag, class text and attribute names are looked up, so a node costs a few
    look-ups however many selectors there are.
    """

    def __init__(self, sels: Iterable[Sel]):
        asked = list(dict.fromkeys(sels))
        parts = list(dict.fromkeys(p for s in asked for p in s.parts()))
        bit = {p: 1 << i for i, p in enumerate(parts)}
        self.keys = {i: p.key() for i, p in enumerate(parts) if p in set(asked)}
        if len(set(self.keys.values())) < len(self.keys):
            raise ValueError("two selectors share a number; write one of them in another way")
        self.asked = sum(1 << i for i in self.keys)
        self.rooted = sum(bit[p] for p in parts if not p.above())
        self.above = {bit[p]: sum(bit[a] for a in set(p.above())) for p in parts if p.above()}
        self.any_tag = sum(bit[p] for p in parts if not p.tag)
        self.tags = {t: self.any_tag | sum(bit[p] for p in parts if p.tag == t) for t in {p.tag for p in parts if p.tag}}
        self.classed = [(bit[p], [f" {p.cls} "] * bool(p.cls) + list(p.cls_has)) for p in parts if p.cls or p.cls_has]
        self.any_class = sum(bit.values()) - sum(b for b, _ in self.classed)
        self.classes: dict[str, int] = {}  # what class texts were found to satisfy
        self.no_attr = sum(bit[p] for p in parts if not p.attr)
        self.attrs: dict[str, list[tuple[int, Sel]]] = defaultdict(list)
        for p in parts:
            if p.attr:
                self.attrs[p.attr].append((bit[p], p))
        self.not_first = ~sum(bit[p] for p in parts if p.is_first)
        self.not_last = ~sum(bit[p] for p in parts if p.is_last)
        self.holding = [(bit[p], p.contains) for p in parts if p.contains]

    _HELD, _SHORT = 10_000, 200

    def _of_class(self, words: str) -> int:
        found = self.classes.get(words)
        if found is None:
            found = self.any_class
            for b, needed in self.classed:
                if all(w in words for w in needed):
                    found |= b
            if len(words) <= self._SHORT:
                if len(self.classes) >= self._HELD:
                    self.classes.clear()
                self.classes[words] = found
        return found

    def of_tag(self, tag: str, cls: str, attrs: dict[str, str]) -> int:
        """Selectors that a start tag satisfies, whatever stands around it."""
        met = self.tags.get(tag, self.any_tag) & (self._of_class(cls) if cls else self.any_class)
        if met:
            named = self.no_attr
            for name in attrs.keys() & self.attrs.keys():
                value = attrs[name]
                for b, p in self.attrs[name]:
                    if value == p.eq if p.eq is not None else p.has is None or p.has in value:
                        named |= b
            met &= named
        return met

    def hits(self, nodes: list[_Node]) -> dict[int, list[int]]:
        """Places of the matching nodes per key of a selector; ``_NOWHERE`` has none."""
        out: dict[int, list[int]] = {_NOWHERE: []}
        not_first, not_last, holding, rooted, asked = self.not_first, self.not_last, self.holding, self.rooted, self.asked
        places: dict[int, list[int]] = {}
        for place, n in enumerate(nodes):
            near, met = n.near, n.base
            n.over = near.over | near.met if near is not None else 0
            if not met:
                n.met = 0
                continue
            if not n.first:
                met &= not_first
            if not n.is_last:
                met &= not_last
            for b, text in holding:
                if met & b and (n.deep is None or text not in "".join(n.deep)):
                    met &= ~b
            waiting = met & ~rooted
            met &= rooted
            while waiting:
                b = waiting & -waiting
                waiting ^= b
                if self.above[b] & n.over:
                    met |= b
            n.met = met
            met &= asked
            if met:  # nodes that satisfy the same selectors are put down together
                places.setdefault(met, []).append(place)
        several = set()
        for met, some in places.items():
            while met:
                b = met & -met
                met ^= b
                key = self.keys[b.bit_length() - 1]
                if key in out:
                    several.add(key)
                out.setdefault(key, []).extend(some)
        for key in several:
            out[key].sort()
        return out


# Nodes kept as Python objects before they are packed into Arrow memory: so few that they are still in the cache.
_NODES_HELD = 1_000


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(accumulate(sizes, initial=0), pa.int32())


def _texts(groups: list[list[tuple[int, str]]]) -> pa.Array:
    flat = [p for g in groups for p in g]
    entries = pa.StructArray.from_arrays(
        [pa.array([p[0] for p in flat], pa.int32()), pa.array([p[1] for p in flat], pa.string())],
        ["pos", "text"],
    )
    return pa.ListArray.from_arrays(_offsets([len(g) for g in groups]), entries)


def _to_arrow(pages: list[list[_Node] | None], index: "_Index | None" = None) -> pa.Array:
    flat = [n for page in pages if page for n in page]
    i32 = pa.int32()
    spans: list[int] = []
    keys: list[int] = []
    lists: list[list[int]] = []
    held: list[int] = []  # entries of the index at each node; only the first of a page has any
    for page in pages:
        if page:
            numbers = [n.idx for n in page]
            spans += [1 if n.last == n.idx else bisect_right(numbers, n.last, i) - i for i, n in enumerate(page)]
            found = index.hits(page) if index else {}
            keys += found
            lists += found.values()
            held.append(len(found))
            held += [0] * (len(page) - 1)
    hits = pa.MapArray.from_arrays(
        _offsets(held), pa.array(keys, i32),
        pa.ListArray.from_arrays(_offsets([len(v) for v in lists]), pa.array(chain.from_iterable(lists), i32)),
    )
    attrs = pa.MapArray.from_arrays(
        _offsets([len(n.attrs) for n in flat]),
        pa.array([k for n in flat for k in n.attrs], pa.string()),
        pa.array([v for n in flat for v in n.attrs.values()], pa.string()),
    )
    inner = pa.StructArray.from_arrays(
        [pa.array([n.inner and n.inner[0] for n in flat], i32),
         pa.array([n.inner and n.inner[1] for n in flat], pa.string())],
        ["pos", "text"],
        mask=pa.array([n.inner is None for n in flat], pa.bool_()),
    )
    around = [n.parent.pieces if n.tag == "label" and n.parent else [] for n in flat]
    entries = pa.StructArray.from_arrays(
        [
            pa.array([n.idx for n in flat], i32),
            pa.array([n.parent.idx if n.parent else None for n in flat], i32),
            pa.array([n.last for n in flat], i32),
            pa.array([n.tag for n in flat], pa.string()),
            pa.array([n.cls for n in flat], pa.string()),
            attrs,
            pa.array([n.first for n in flat], pa.bool_()),
            pa.array([n.is_last for n in flat], pa.bool_()),
            _texts([n.pieces for n in flat]),
            inner,
            _texts(around),
            pa.array([None if n.deep is None else "".join(n.deep) for n in flat], pa.string()),
            pa.array([n.start for n in flat], i32),
            pa.array([n.stop for n in flat], i32),
            pa.array(chain.from_iterable(range(len(page)) for page in pages if page), i32),
            pa.array(spans, i32),
            hits,
        ],
        [f.name for f in NODE.fields],
    )
    starts = _offsets([len(p) if p else 0 for p in pages])
    missing = pa.array([p is None for p in pages], pa.bool_())
    return pa.ListArray.from_arrays(starts, entries, mask=missing)


def parse_nodes(
    html: Column, used: Iterable[Sel] | None = None, full_text: Iterable[str] = ("a",), index: Iterable[Sel] | None = None
) -> Column:
    """Array of nodes of a page.

    ``used`` lists the selectors of the query, to leave out nodes none of them
    can match.  ``index`` lists those that are asked of a :class:`PageNodes`
    column (default: all of ``used``).  ``full_text`` names the tags whose whole inner text is wanted
    for ``contains``.  Marked non-deterministic so that no optimizer rule copies
    the call into a filter and reads each page twice; filter on plain columns
    before parsing.
    """
    used = None if used is None else list(used)
    asked = list(index if index is not None else used or ())
    keep = _Keep.of([*used, *asked]) if used is not None else None
    index = _Index(asked) if asked else None
    wide = frozenset(full_text)

    def read(batch: pa.Array) -> pa.Array:
        done: list[pa.Array] = []
        pages: list[list[_Node] | None] = []
        held = 0
        start_tags = _StartTags(keep, index)
        collecting = gc.isenabled()
        gc.disable()  # many small objects and no cycles among them
        try:
            for value in batch:
                source = value.as_py()
                pages.append(None if source is None else _read_page(source, wide, start_tags))
                held += len(pages[-1] or ())
                if held > _NODES_HELD:
                    done.append(_to_arrow(pages, index))
                    pages, held = [], 0
            done.append(_to_arrow(pages, index))
        finally:
            if collecting:
                gc.enable()
        return pa.concat_arrays(done)

    read.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(read, NODES).asNondeterministic()(html)

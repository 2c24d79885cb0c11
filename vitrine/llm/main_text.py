"""Main text of web pages: a linear-chain CRF over the blocks of a page, decoded by Viterbi.

Each block has features of its ancestors (tags, and the words of class, id and
role), of the innermost telling ancestor, and of its text (length, share in
links, punctuation).  A conditional random field with two labels, main text or
not, is trained by gradient ascent on the likelihood of labelled pages.  No
labelled pages are given, so ``labelled_page`` writes them: layouts of articles
with menus, headers, footers, sidebars, notices, adverts, forms, related links
and reader comments, under many names and often without a name, filled with
random words.  The pages to extract are never used in training, and the model
is the same at every run.

Null and empty pages give an empty text.  Extra columns are not returned.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import byte_slices
from vitrine.llm.page_blocks import Block, read_blocks

PAGES = 400
STEPS = 120
RATE = 0.1
RIDGE = 0.02
SEED = 11

_ROUND_BYTES = 4 << 20

# Names that sites give to the parts of a page.
MAIN_NAMES = ("article", "content", "post", "entry", "story", "main", "body", "text", "single", "blog")
OTHER_NAMES = {
    "menu": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topnav", "tabs", "toc", "pagination"),
    "header": ("header", "masthead", "banner", "top", "logo", "branding", "hero"),
    "footer": ("footer", "copyright", "bottom", "legal", "colophon", "foot"),
    "sidebar": ("sidebar", "side", "aside", "widget", "rail", "related", "recommended", "popular", "trending", "tags"),
    "notice": ("notice", "cookie", "consent", "gdpr", "alert", "popup", "modal", "disclaimer", "overlay", "warning"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "adsense", "commercial"),
    "form": ("form", "subscribe", "newsletter", "search", "login", "signup", "contact", "register"),
    "comments": ("comment", "comments", "disqus", "discussion", "replies", "responses", "reply", "feedback"),
    "share": ("share", "social", "sharing", "follow", "buttons", "toolbar", "meta", "author"),
}
_OTHERS = frozenset(n for names in OTHER_NAMES.values() for n in names)
_TAGS = frozenset("article main section header footer nav aside form figure table ul ol blockquote button fieldset dialog "
                  "menu address details".split())
_TELLING = _OTHERS | frozenset("nav header footer aside form dialog menu button article main".split()) | frozenset(MAIN_NAMES)


def _text_features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    size = "1" if words == 1 else "few" if words < 5 else "line" if words < 12 else "lines" if words < 40 else "long"
    linked = block.linked / len(text)
    links = "all" if linked > 0.9 else "most" if linked > 0.4 else "some" if linked > 0 else "none"
    out = [f"words:{size}", f"links:{links}", f"end:{text[-1] in '.!?…:;»”\"'}", f"size:{size}/links:{links}"]
    if "©" in text or "(c)" in text:
        out.append("copyright")
    if "|" in text or "·" in text or "»" in text or "›" in text:
        out.append("bars")
    if words > 4 and text.count(",") * 25 > words:
        out.append("commas")
    return out


def around(state: tuple | None, tag: str, names: tuple) -> tuple:
    """What is known inside an element: the telling tags and names around it, and the innermost of them."""
    seen, inner = state or (frozenset(), "none")
    more = set()
    if tag in _TAGS:
        more.add(f"in:{tag}")
    if tag in _TELLING:
        inner = f"tag {tag}"
    for name in names:
        if name in _TELLING:
            more.add(f"name:{name}")
            inner = f"name {name}"
    return (seen if seen.issuperset(more) else seen | more), inner


def block_features(block: Block) -> list[str]:
    """Names of the features that hold for a block, each once."""
    seen, inner = block.state or (frozenset(), "none")
    out = _text_features(block)
    prose = "prose" if out[0] in ("words:lines", "words:long") else "short"
    return [*out, f"own:{block.tag}", *sorted(seen), f"inner:{inner}", f"inner:{inner}/{prose}"]


# -- labelled pages ---------------------------------------------------------------------------------------------

_SYLLABLES = "an be ca do el fi gu ha in jo ka lu me no or pa qui re sa te un va wi zo ar est ion er ing le".split()


class _Writer:
    """Writes one labelled page; each block starts with a mark that tells its label."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        return " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(low, high)))

    def prose(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.rng.randint(low, high)):
            words = self.words(3, 22).capitalize()
            if self.rng.random() < 0.5 and " " in words:
                words = words.replace(" ", ", ", 1)
            out.append(words + self.rng.choice("...!?"))
        return " ".join(out)

    def block(self, tag: str, label: int, text: str, link: bool = False) -> str:
        inner = f"<a href='/{len(text)}'>{text}</a>" if link else text
        if self.rng.random() < 0.1:
            inner = f"<b>{inner}" if self.rng.random() < 0.3 else f"<span>{inner}</span>"
        end = "" if tag in ("p", "li") and self.rng.random() < 0.3 else f"</{tag}>"
        return f"<{tag}>§{label} {inner}{end}"

    def named(self, names: tuple[str, ...], tag: str, inner: str, chance: float = 0.8) -> str:
        rng = self.rng
        if rng.random() > chance:
            return f"<{tag}>{inner}</{tag}>"
        name = rng.choice(names)
        if rng.random() < 0.4:
            name += rng.choice(("-", "_")) + rng.choice(("wrap", "box", "inner", "list", "area", "block", "1"))
        return f"<{tag} {rng.choice(('class', 'class', 'id'))}=\"{name}\">{inner}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = "".join(self.block("li", 0, self.words(1, 4), link=True) for _ in range(self.rng.randint(low, high)))
        return f"<ul>{items}</ul>"

    def other(self, kind: str) -> str:
        rng, names = self.rng, OTHER_NAMES[kind]
        if kind == "menu":
            return self.named(names, rng.choice(("nav", "div", "nav")), self.links(2, 9))
        if kind == "header":
            inner = self.block(rng.choice(("div", "h1", "h2", "p")), 0, self.words(1, 8))
            return self.named(names, rng.choice(("header", "div", "header")), inner + (self.links(1, 4) if rng.random() < 0.4 else ""))
        if kind == "footer":
            inner = self.block(rng.choice(("p", "div", "small")) if rng.random() < 0.7 else "p", 0, rng.choice(
                (f"© 2020 {self.words(1, 5)}", f"&copy; {self.words(1, 4)} &middot; {self.prose(1, 1)}", self.prose(1, 3))))
            return self.named(names, rng.choice(("footer", "div", "footer")), inner + (self.links(1, 5) if rng.random() < 0.5 else ""))
        if kind == "sidebar":
            inner = self.block("h3", 0, self.words(1, 3)) + rng.choice((self.links(2, 6), self.block("p", 0, self.prose(1, 3))))
            return self.named(names, rng.choice(("aside", "div", "aside")), inner)
        if kind == "form":
            inner = self.block("p", 0, self.prose(1, 2)) + self.block("label", 0, self.words(1, 3)).replace(
                "<label>", "<div>").replace("</label>", "</div>") + "<input name=x>" + self.block("button", 0, self.words(1, 2))
            return self.named(names, rng.choice(("form", "form", "div")), inner)
        if kind == "comments":
            items = "".join(self.named(("comment", "reply", "comment"), rng.choice(("div", "li", "article")),
                            self.block(rng.choice(("cite", "h4", "span")).replace("cite", "h5").replace("span", "p"), 0, self.words(1, 3))
                            + self.block("p", 0, self.prose(1, 4)), 0.6) for _ in range(rng.randint(1, 5)))
            return self.named(names, rng.choice(("section", "div", "ol")), self.block("h3", 0, self.words(1, 2)) + items, 1.0)
        if kind == "share":
            return self.named(names, "div", self.links(2, 4) if rng.random() < 0.6 else self.block("p", 0, self.words(1, 5)), 1.0)
        inner = "".join(self.block(rng.choice(("p", "div")), 0, self.prose(1, 3)) for _ in range(rng.randint(1, 2)))
        if rng.random() < 0.4:  # text right inside the element
            inner = f"§0 {self.prose(1, 3)}"
        return self.named(names, rng.choice(("div", "section", "div")), inner, 1.0)

    def article(self) -> str:
        rng = self.rng
        parts = [self.block(rng.choice(("h1", "h1", "h2")), 1, self.words(2, 12))] if rng.random() < 0.9 else []
        if parts and rng.random() < 0.15:
            parts = [f"<header>{parts[0]}</header>"]
        for _ in range(rng.randint(1, 14)):
            draw = rng.random()
            if draw < 0.72:
                parts.append(self.block("p", 1, self.prose(1, 6)))
            elif draw < 0.8:
                parts.append(self.block(rng.choice(("h2", "h3")), 1, self.words(1, 7)))
            elif draw < 0.85:
                items = "".join(self.block("li", 1, self.prose(1, 2)) for _ in range(rng.randint(2, 5)))
                parts.append(f"<ul>{items}</ul>")
            elif draw < 0.88:
                parts.append(self.block("blockquote", 1, self.prose(1, 3)))
            elif draw < 0.9:
                parts.append(self.block("pre", 1, self.words(3, 20)))
            elif draw < 0.92:
                cells = "".join(f"<td>§1 {self.words(1, 3)}</td>" for _ in range(rng.randint(2, 4)))
                parts.append(f"<table><tr>{cells}</tr></table>")
            elif draw < 0.94:
                parts.append(f"<figure><img src=x>{self.block('figcaption', 1, self.prose(1, 1))}</figure>")
            elif draw < 0.96:
                parts.append(self.block("p", 1, self.words(1, 3)))
            else:
                parts.append(self.other(rng.choice(("advert", "share", "sidebar", "form"))))
        inner = "".join(parts)
        layout = rng.random()
        if layout < 0.4:
            return f"<article>{inner}</article>" if rng.random() < 0.6 else self.named(MAIN_NAMES, "article", inner)
        if layout < 0.55:
            return f"<main>{inner}</main>"
        if layout < 0.9:
            return self.named(MAIN_NAMES, rng.choice(("div", "section", "td", "div")).replace("td", "div"), inner, 0.9)
        return f"<div>{inner}</div>"

    def page(self) -> str:
        rng = self.rng
        before = [self.other(k) for k in ("header", "menu", "notice", "advert", "form", "sidebar", "menu") if rng.random() < 0.4]
        after = [self.other(k) for k in ("share", "comments", "sidebar", "advert", "form", "footer", "notice", "footer")
                 if rng.random() < 0.45]
        rng.shuffle(before)
        body = "".join([*before, self.article(), *after])
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(("page", "wrapper", "container", "site"))}">{body}</div>'
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def labelled_page(seed: int) -> tuple[list[Block], list[int]]:
    """The blocks of a written page and which of them are main text."""
    blocks = read_blocks(_Writer(seed).page(), around)
    labels = [int(b.text[1]) for b in blocks]
    for b in blocks:
        b.text = b.text[3:] or "x"
    return blocks, labels


# -- the model --------------------------------------------------------------------------------------------------

class ChainModel:
    """Weights of the features for "main", of the first label and of label changes."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, change: np.ndarray):
        self.weights, self.start, self.change = weights, start.tolist(), change.tolist()

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        if not blocks:
            return []
        get = self.weights.get
        gains = [sum(get(f, 0.0) for f in block_features(b)) for b in blocks]
        (oo, om), (mo, mm) = self.change
        other, main = self.start[0], self.start[1] + gains[0]
        came = []
        for gain in gains[1:]:
            from_other = (other + oo >= main + mo, other + om >= main + mm)
            came.append(from_other)
            other, main = (max(other + oo, main + mo), max(other + om, main + mm) + gain)
        label = main > other
        out = [label]
        for to_other, to_main in reversed(came):
            label = not (to_main if label else to_other)
            out.append(label)
        return out[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@functools.cache
def train(pages: int = PAGES, steps: int = STEPS, seed: int = SEED) -> ChainModel:
    """Fit the field to the labelled pages: forward-backward over all pages at once, Adam on the mean log likelihood."""
    examples = [labelled_page(seed * 100_000 + i) for i in range(pages)]
    examples = [e for e in examples if e[0]]
    ids: dict[str, int] = {}
    rows, cols, at = [], [], []
    longest = max(len(b) for b, _ in examples)
    n = len(examples)
    gold = np.zeros((n, longest), dtype=np.int64)
    mask = np.zeros((n, longest), dtype=bool)
    for p, (blocks, labels) in enumerate(examples):
        for t, (block, label) in enumerate(zip(blocks, labels)):
            gold[p, t], mask[p, t] = label, True
            for name in block_features(block):
                rows.append(p * longest + t)
                cols.append(ids.setdefault(name, len(ids)))
    rows, cols = np.array(rows), np.array(cols)
    k = len(ids)
    theta, first, second = np.zeros(k + 6), np.zeros(k + 6), np.zeros(k + 6)
    lengths = mask.sum(axis=1)
    for step in range(1, steps + 1):
        weights, start, change = theta[:k], theta[k:k + 2], theta[k + 2:].reshape(2, 2)
        gains = np.bincount(rows, weights[cols], n * longest).reshape(n, longest)
        emit = np.stack([np.zeros_like(gains), gains], axis=2)
        alpha = np.zeros((n, longest, 2))
        alpha[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            stepped = _log_sum(alpha[:, t - 1, :, None] + change, 1) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], stepped, alpha[:, t - 1])
        beta = np.zeros((n, longest, 2))
        pairs = np.zeros((2, 2))
        log_z = _log_sum(alpha[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            onward = change + (emit[:, t + 1] + beta[:, t + 1])[:, None, :]
            beta[:, t] = np.where(mask[:, t + 1, None], _log_sum(onward, 2), beta[:, t + 1])
            joint = np.exp(alpha[:, t, :, None] + onward - log_z[:, None, None])
            pairs += joint[mask[:, t + 1]].sum(axis=0)
        marginal = np.exp(alpha + beta - log_z[:, None, None])[:, :, 1]
        slope = np.where(mask, gold - marginal, 0.0).reshape(-1)
        grad = np.zeros(k + 6)
        grad[:k] = np.bincount(cols, slope[rows], k)
        began = np.exp(alpha[:, 0] + beta[:, 0] - log_z[:, None])
        grad[k:k + 2] = np.bincount(gold[:, 0], minlength=2) - began.sum(axis=0)
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
        grad[k + 2:] = (seen - pairs).reshape(-1)
        grad = grad / n - RIDGE * theta / np.sqrt(n)
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return ChainModel({name: float(theta[i]) for name, i in ids.items()}, theta[k:k + 2], theta[k + 2:].reshape(2, 2))


def main_text(page: str | None, model: ChainModel) -> str:
    blocks = read_blocks(page, around)
    return "\n\n".join(b.text for b, main in zip(blocks, model.decode(blocks)) if main)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    model = train()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html", _ROUND_BYTES):
            texts = [main_text(page, model) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        extracted, f"page_id {id_type}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))

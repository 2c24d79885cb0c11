"""Product pages -> product columns.

Each function takes a :class:`Page` (the parsed nodes, the address and the
source of one row) and returns one Column.  :func:`product_rows` puts them
together in a few narrow steps, so that shared parts (characteristics, volume,
base address) are evaluated once per page.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.jsontext import parsed_json
from vitrine.functions import text
from vitrine.functions.nodes import (
    PageNodes, Sel, all_attrs, all_texts, first_attr, first_inner_text, first_list, first_of, first_outer_or_text,
    box, each, exists, first_text, let, parse_nodes, quoted, select, where,
)
from vitrine.functions.truth import variant_filled_sql
from vitrine.schemas import ASSETS, PRICE_DATA, PRODUCT, STOCK


@dataclass(frozen=True)
class Page:
    """Names of the columns that hold one page."""

    nodes: PageNodes = PageNodes("nodes")
    url: str = "url"
    html: str = "html"
    base: str = "base"


# ---------------------------------------------------------------------------
# Where each field is looked for, in order.
# ---------------------------------------------------------------------------

PRODUCT_MARK = (Sel("h1"), Sel(cls="product-title"), Sel(cls="title"))

ID_DIV = Sel("div", attr="data-product-id")
ID_INPUT = Sel("input", attr="name", eq="product_id")
TITLES = (Sel("h1", cls="product-title"), Sel("h1"), Sel(cls="product-name"))
VOLUME_ATTR, VOLUME_TEXT, SPAN = Sel(attr="data-volume"), Sel(cls="product-volume"), Sel("span")
BRAND_TEXT, BRAND_ATTR, BRAND_LINK = Sel(cls="brand-name"), Sel(attr="data-brand"), Sel("a", cls="brand-link")
SKU_ATTR, SKU_INPUT, LABEL = Sel(attr="data-sku"), Sel("input", attr="name", eq="sku"), Sel("label")
SKU_LABELS = ("SKU", "Артикул")
CRUMBS = (Sel("a", within=Sel(cls="breadcrumb")), Sel(cls="breadcrumb-link"))
TAGS = (Sel(cls="product-tag"), Sel(cls="tag"), Sel(cls_has=("badge",)))

PRICE_NOW, PRICE_PLAIN, PRICE_ATTR = Sel(cls="price-current"), Sel(cls="product-price"), Sel(attr="data-price")
PRICE_SPAN = Sel("span", cls_has=("price",))
PRICE_OLD, PRICE_ORIGINAL = Sel(cls="price-old"), Sel(cls="price-original")
PRICE_OLD_ATTR, PRICE_OLD_PLAIN = Sel(attr="data-original-price"), Sel(cls="product-original-price")

BUY = (Sel("button", cls="buy-btn"), Sel("button", attr="data-action", eq="add-to-cart"))
IN_STOCK, IN_STOCK_TEXT = Sel(cls="in-stock"), Sel(cls="availability-in-stock")
NO_STOCK, NO_STOCK_TEXT = Sel(cls="out-of-stock"), Sel(cls="availability-out")
STOCK_COUNT = Sel(attr="data-stock-count")
STATUS_TEXT = (Sel(cls="stock-status"), Sel(cls="availability-text"))
PREORDER = (Sel(cls="preorder"), Sel(attr="data-preorder"))
ON_ORDER = Sel(cls="on-order")

MAIN_IMAGES = (
    (Sel("img", within=Sel(cls="product-image-main")), "src"),
    (Sel(cls="product-main-image"), "src"),
    (Sel("img", cls_has=("main",)), "src"),
    (Sel(attr="data-main-image"), "data-main-image"),
)
GALLERY = (
    Sel("img", within=Sel(cls="product-gallery")),
    Sel("img", within=Sel(cls="product-carousel")),
    Sel("img", within=Sel(cls_has=("gallery",))),
    Sel("img", cls_has=("product",)),
)
JSON_SCRIPT = Sel("script", attr="type", eq="application/json")
LD_SCRIPT = Sel("script", attr="type", eq="application/ld+json")
VIEWS = (
    (Sel(attr="data-360"), "data-360"),
    (Sel("img", within=Sel(cls="view-360")), "src"),
    (Sel("img", attr="data-type", has="360"), "src"),
)
VIDEO_SOURCE, VIDEO = Sel("source", within=Sel("video")), Sel("video")
FRAMES = (Sel("iframe", attr="src", has="youtube"), Sel("iframe", attr="src", has="vimeo"))

DESCRIPTION, DESCRIPTION_PART = Sel(cls="product-description"), Sel(cls_has=("description",))
DESCRIPTION_DIV, DESCRIPTION_P = Sel("div", cls_has=("description",)), Sel("p", cls="product-text")

SPEC_ROWS = (Sel("tr", within=(
    Sel("table", cls="characteristics"), Sel("table", cls="specs"), Sel("table", cls_has=("char",)))),)
ROW_KEYS = (Sel(cls="char-name"), Sel(cls="spec-name"), Sel("td", is_first=True))
ROW_VALUES = (Sel(cls="char-value"), Sel(cls="spec-value"), Sel("td", is_last=True))
CELL = Sel("td")
SPEC_LISTS = (Sel(cls="specs-list"), Sel(cls="characteristics-list"), Sel(cls_has=("specs",)))
LIST_KEYS = (Sel("dt"), Sel(cls="spec-label"), Sel(cls="label"))
LIST_VALUES = (Sel("dd"), Sel(cls="spec-value"), Sel(cls="value"))
SPEC_DIVS = (Sel(cls_has=("specification",)), Sel(cls_has=("feature",)), Sel(cls_has=("attribute",)))
DIV_KEYS, DIV_KEY_TEXT = (Sel(cls_has=("key",)), Sel(cls_has=("name",))), Sel(cls_has=("label",))
DIV_VALUES, DIV_VALUE_TEXT = (Sel(cls_has=("value",)),), Sel(cls_has=("content",))
LD_RESERVED = ("@context", "@type", "url", "image", "name", "description")

ROUTES = {
    "volume": ("объем", "volume", "size"),
    "alcohol_content": ("крепость", "alcohol content", "abv"),
    "country": ("страна", "country", "производство"),
    "year": ("год", "year", "vintage"),
}
SPECIAL = {
    "volume": ("volume", ("объем", "volume", "size")),
    "alcohol_content": ("alcohol", ("крепость", "alcohol", "abv")),
    "country": ("country", ("страна", "country", "производство")),
    "year": ("year", ("год", "year", "vintage")),
    "sku": ("sku", ("артикул", "sku", "product code")),
    "product_code": ("code", ("код", "code", "product code")),
}
RATING, REVIEWS = Sel("span", cls="rating-value"), Sel("span", cls="review-count")

VOLUME_OPTIONS = (
    Sel("option", within=Sel(cls="volume-selector")),
    Sel("option", within=Sel("select", attr="name", has="volume")),
    Sel("option", within=Sel("select", cls_has=("volume",))),
)
VOLUME_BUTTONS = (
    Sel(cls="volume-btn"), Sel(cls_has=("volume", "btn")), Sel(cls="size-button", attr="data-volume"),
)
COLOR_OPTIONS = (
    Sel("option", within=Sel(cls="color-selector")),
    Sel("option", within=Sel("select", attr="name", has="color")),
    Sel("option", within=Sel("select", cls_has=("color",))),
)
COLOR_BUTTONS = (Sel(cls="color-btn"), Sel(cls_has=("color", "btn")), Sel(attr="data-color"))
COLOR_LIST, VARIANT_LIST = Sel(attr="data-available-colors"), Sel(attr="data-variants")

NOT_A_VARIANT = (
    "размер", "size", "одежда", "clothing", "shirt", "pants", "dress", "обувь", "shoe", "носок", "sock",
    "width", "длина", "height", "высота", "material", "материал", "ткань", "fabric",
    "large", "small", "medium", "extra",
)
SIZES = ("xs", "s", "m", "l", "xl", "xxl")
PLACEHOLDERS = ("select", "выбрать", "choose", "выбор")

BASE = Sel("base", attr="href")


def _selectors_in(value) -> list[Sel]:
    if isinstance(value, Sel):
        return [value]
    if isinstance(value, tuple):
        return [s for v in value for s in _selectors_in(v)]
    return []


USED = [s for name, value in list(globals().items()) if name.isupper() for s in _selectors_in(value)]
USED += [Sel(attr=f"data-{field}") for field, _ in SPECIAL.values()]
CHARACTERISTICS_USED = _selectors_in((
    SPEC_ROWS, ROW_KEYS, ROW_VALUES, CELL, SPEC_LISTS, LIST_KEYS, LIST_VALUES, SPEC_DIVS, DIV_KEYS, DIV_KEY_TEXT,
    DIV_VALUES, DIV_VALUE_TEXT, LD_SCRIPT))
GALLERY_USED = _selectors_in((GALLERY, JSON_SCRIPT))
ID_USED = _selectors_in((ID_DIV, ID_INPUT))
VOLUME_USED = _selectors_in((VOLUME_ATTR, VOLUME_TEXT, SPAN))
TITLE_USED = [*_selectors_in(TITLES), *VOLUME_USED]
BRAND_USED = _selectors_in((BRAND_TEXT, BRAND_ATTR, BRAND_LINK))
SKU_USED = _selectors_in((SKU_ATTR, SKU_INPUT, LABEL))
CRUMBS_USED, TAGS_USED = _selectors_in(CRUMBS), _selectors_in(TAGS)
CURRENT_USED = _selectors_in((PRICE_NOW, PRICE_PLAIN, PRICE_ATTR, PRICE_SPAN))
ORIGINAL_USED = _selectors_in((PRICE_OLD, PRICE_ORIGINAL, PRICE_OLD_ATTR, PRICE_OLD_PLAIN))
IN_STOCK_USED = _selectors_in((BUY, IN_STOCK, IN_STOCK_TEXT, NO_STOCK, NO_STOCK_TEXT))
COUNT_USED = [STOCK_COUNT]
STATUS_USED = _selectors_in((STATUS_TEXT, PREORDER, ON_ORDER, NO_STOCK, IN_STOCK))
MAIN_USED, VIEWS_USED = _selectors_in(MAIN_IMAGES), _selectors_in(VIEWS)
VIDEO_USED = _selectors_in((VIDEO_SOURCE, VIDEO, FRAMES))
DESCRIPTION_USED = _selectors_in((DESCRIPTION, DESCRIPTION_PART, DESCRIPTION_DIV, DESCRIPTION_P))
SPECIAL_USED = [*CHARACTERISTICS_USED, *(Sel(attr=f"data-{attr}") for attr, _ in SPECIAL.values())]
VOLUMES_USED = _selectors_in((VOLUME_OPTIONS, VOLUME_BUTTONS))
COLORS_USED = _selectors_in((COLOR_OPTIONS, COLOR_BUTTONS, COLOR_LIST))
JSON_VARIANTS_USED = _selectors_in((JSON_SCRIPT, VARIANT_LIST))
RATING_USED = [RATING, REVIEWS]


# ---------------------------------------------------------------------------
# Identity and labels
# ---------------------------------------------------------------------------


def base_url(nodes: PageNodes = PageNodes("nodes"), url: str = "url") -> Column:
    """Address that relative links of the page refer to."""
    given = text.strip(F.expr(first_attr(select(nodes, BASE), "href")))
    resolved = text.bind(given, lambda g: text.resolve_url(F.col(url), g))
    return F.when(F.expr(exists(nodes, BASE)), resolved).otherwise(F.col(url))


def is_product_page(p: Page) -> Column:
    return F.expr(exists(p.nodes, PRODUCT_MARK))


def product_id(p: Page) -> Column:
    parts = f"split({p.url}, '/', -1)"
    digits = where(parts, lambda s: f"{s} RLIKE '^[0-9]+$'")
    found = first_of(
        first_attr(select(p.nodes, ID_DIV), "data-product-id"),
        first_attr(select(p.nodes, ID_INPUT), "value"),
        f"try_element_at({digits}, -1)",
    )
    return F.expr(f"coalesce({found}, try_element_at({parts}, -1))")


def volume(p: Page) -> Column:
    named = where(select(p.nodes, SPAN), lambda n: f"contains(try_element_at({n}.texts, 1).text, 'л')")
    return text.strip(F.expr(first_of(
        first_attr(select(p.nodes, VOLUME_ATTR), "data-volume"),
        first_text(select(p.nodes, VOLUME_TEXT)),
        first_inner_text(named),
    )))


def title(heading: Column, of_volume: Column) -> Column:
    """Heading, with the volume added unless it is named already."""
    head = text.strip(heading)
    add = (F.coalesce(of_volume, F.lit("")) != "") & ~F.contains(head, of_volume)
    return F.when(add, F.concat_ws(" ", head, of_volume)).otherwise(head)


def heading(p: Page) -> Column:
    return F.expr(first_of(*[first_text(select(p.nodes, s)) for s in TITLES]))


def brand(p: Page) -> Column:
    return text.strip(F.expr(first_of(
        first_text(select(p.nodes, BRAND_TEXT)),
        first_attr(select(p.nodes, BRAND_ATTR), "data-brand"),
        first_text(select(p.nodes, BRAND_LINK)),
    )))


def sku(p: Page) -> Column:
    def named(n: str) -> str:
        head = f"try_element_at({n}.texts, 1).text"
        return " OR ".join(f"contains({head}, {quoted(w)})" for w in SKU_LABELS)

    beside = f"flatten({each(where(select(p.nodes, LABEL), named), lambda n: f'{n}.around')})"
    return text.strip(F.expr(first_of(
        first_attr(select(p.nodes, SKU_ATTR), "data-sku"),
        first_attr(select(p.nodes, SKU_INPUT), "value"),
        f"array_min({beside}).text",
    )))


def _stripped(values: str, shortest: int = 1) -> Column:
    return F.filter(F.transform(F.expr(values), text.strip), lambda v: F.length(v) >= shortest)


def _texts_of(p: Page, choices: tuple) -> str:
    return first_list(*[all_texts(select(p.nodes, s)) for s in choices])


def breadcrumbs(p: Page) -> Column:
    return _stripped(_texts_of(p, CRUMBS))


def marketing_tags(p: Page) -> Column:
    return _stripped(_texts_of(p, TAGS), 2)


def description(p: Page) -> Column:
    return text.strip(F.expr(first_of(
        first_text(select(p.nodes, DESCRIPTION)),
        first_text(select(p.nodes, DESCRIPTION_PART)),
        first_inner_text(select(p.nodes, DESCRIPTION_DIV)),
        first_text(select(p.nodes, DESCRIPTION_P)),
    )))


def rating(p: Page) -> Column:
    read = F.transform(F.expr(all_texts(select(p.nodes, RATING))), text.extract_float)
    return text.first_value(F.filter(read, lambda v: v.isNotNull()))


def review_count(p: Page) -> Column:
    read = F.transform(F.expr(all_texts(select(p.nodes, REVIEWS))), text.extract_number)
    return text.first_value(F.filter(read, lambda v: v.isNotNull())).try_cast("int")


# ---------------------------------------------------------------------------
# Prices and stock
# ---------------------------------------------------------------------------


def current_price(p: Page) -> Column:
    return text.parse_price(F.expr(first_of(
        first_text(select(p.nodes, PRICE_NOW)),
        first_text(select(p.nodes, PRICE_PLAIN)),
        first_attr(select(p.nodes, PRICE_ATTR), "data-price"),
        first_inner_text(select(p.nodes, PRICE_SPAN)),
    )))


def original_price(p: Page) -> Column:
    return text.parse_price(F.expr(first_of(
        first_text(select(p.nodes, PRICE_OLD)),
        first_text(select(p.nodes, PRICE_ORIGINAL)),
        first_attr(select(p.nodes, PRICE_OLD_ATTR), "data-original-price"),
        first_text(select(p.nodes, PRICE_OLD_PLAIN)),
    )))


def price_data(current: Column, original: Column) -> Column:
    """Null without a current price; a missing original price equals the current."""
    full = F.when(F.coalesce(original, F.lit(0.0)) == 0, current).otherwise(original)
    percent = text.calculate_discount(full, current)
    return F.when(
        current != 0,
        F.struct(
            current.alias("current"),
            full.alias("original"),
            F.when(percent > 0, F.format_string("Скидка %d%%", percent)).alias("sale_tag"),
            F.lit("RUB").alias("currency"),
        ).cast(PRICE_DATA.schema),
    )


def in_stock(p: Page) -> Column:
    """True, false, or null when the page does not say."""
    def says(outer: Sel, inner: Sel, word: str) -> str:
        found = first_outer_or_text(select(p.nodes, outer), select(p.nodes, inner), p.html)
        return f"contains(lower({found}), '{word}')"

    return F.expr(
        f"CASE WHEN {exists(p.nodes, BUY)} THEN true"
        f" WHEN {says(IN_STOCK, IN_STOCK_TEXT, 'в наличии')} THEN true"
        f" WHEN {says(NO_STOCK, NO_STOCK_TEXT, 'нет')} THEN false END")


def stock_count(p: Page) -> Column:
    """``5 шт`` in the first text of the page, else the count attribute."""
    head = F.expr(f"try_element_at({p.nodes}, 1).inner.text")
    counted = F.regexp_extract(head, r"(?iu)(\d+)\s*шт", 1).try_cast("int")
    given = F.expr(all_attrs(select(p.nodes, STOCK_COUNT), "data-stock-count"))
    return F.coalesce(counted, text.int_value(given).try_cast("int"))


def stock_status(p: Page) -> Column:
    return text.strip(F.expr(
        f"coalesce({first_of(first_text(select(p.nodes, STATUS_TEXT)))}, CASE"
        f" WHEN {exists(p.nodes, PREORDER)} THEN 'Предзаказ'"
        f" WHEN {exists(p.nodes, ON_ORDER)} THEN 'Под заказ'"
        f" WHEN {exists(p.nodes, NO_STOCK)} THEN 'Нет в наличии'"
        f" WHEN {exists(p.nodes, IN_STOCK)} THEN 'В наличии' END)"))


def stock_data(available: Column, count: Column, status: Column) -> Column:
    return F.when(
        available.isNotNull() | (status != ""),
        F.struct(
            F.coalesce(available, F.lit(True)).alias("in_stock"),
            F.coalesce(count, F.lit(0)).alias("count"),
            status.alias("status"),
            F.array().cast("array<string>").alias("available_regions"),
        ).cast(STOCK.schema),
    )


# ---------------------------------------------------------------------------
# Images and video
# ---------------------------------------------------------------------------


def main_image(p: Page) -> Column:
    found = F.expr(first_of(*[first_attr(select(p.nodes, s), a) for s, a in MAIN_IMAGES]))
    return text.bind(found, lambda u: text.normalize_url(F.col(p.base), u))


def _normalized(p: Page, urls: str) -> Column:
    full = F.transform(F.expr(urls), lambda u: text.normalize_url(F.col(p.base), u))
    return F.array_distinct(F.filter(full, lambda u: u.isNotNull() & (u != "")))


def _object(v: str) -> str:
    """A JSON object as a map; null for anything else."""
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def _array(v: str, path: str = "$") -> str:
    return f"try_variant_get({v}, {quoted(path)}, 'array<variant>')"


def _image_key(key: str) -> str:
    return f"(contains(lower({key}), 'image') OR contains(lower({key}), 'src'))"


def _image_strings(pairs: str) -> str:
    named = where(pairs, lambda e: f"{_image_key(f'{e}.key')} AND schema_of_variant({e}.value) = 'STRING'")
    return each(named, lambda e: f"CAST({e}.value AS STRING)")


_NO_TEXTS = "CAST(array() AS ARRAY<STRING>)"


def images_from_json(p: Page) -> str:
    """SQL: text values under image/src keys, top level and in lists of objects."""
    def of_item(item: str) -> str:
        return let(f"map_entries({_object(item)})", lambda e: f"coalesce({_image_strings(e)}, {_NO_TEXTS})")

    def of_document(pairs: str) -> str:
        lists = where(pairs, lambda e: f"schema_of_variant({e}.value) LIKE 'ARRAY%'")
        listed = each(lists, lambda e: f"flatten({each(_array(f'{e}.value'), of_item)})")
        return f"concat({_image_strings(pairs)}, flatten({listed}))"

    scripts = where(all_texts(select(p.nodes, JSON_SCRIPT)), _image_key)
    found = each(scripts, lambda s: let(
        f"map_entries({_object(parsed_json(s))})",
        lambda pairs: f"coalesce({of_document(pairs)}, {_NO_TEXTS})"))
    return f"flatten({found})"


def gallery_images(p: Page) -> Column:
    sources = [all_attrs(select(p.nodes, s), "src") for s in GALLERY] + [images_from_json(p)]
    return F.array_sort(_normalized(p, first_list(*sources)))


def view_360(p: Page) -> Column:
    found = first_list(*[all_attrs(select(p.nodes, s), a) for s, a in VIEWS])
    return F.array_sort(_normalized(p, found))


def video_urls(p: Page) -> Column:
    frames = "concat(" + ", ".join(all_attrs(select(p.nodes, s), "src") for s in FRAMES) + ")"
    framed = F.transform(
        F.expr(frames),
        lambda u: F.when(u.startswith("http"), u).otherwise(text.resolve_url(F.col(p.base), u)))
    return F.array_distinct(F.concat(
        _normalized(p, all_attrs(select(p.nodes, VIDEO_SOURCE), "src")),
        framed,
        _normalized(p, all_attrs(select(p.nodes, VIDEO), "src")),
    ))


def assets(main: Column, gallery: Column, views: Column, videos: Column) -> Column:
    return F.when(
        (F.coalesce(main, F.lit("")) != "") | (F.size(gallery) > 0) | (F.size(videos) > 0),
        F.struct(
            main.alias("main_image"), gallery.alias("gallery_images"), views.alias("view_360"),
            videos.alias("video"), F.array().cast("array<string>").alias("cached_images"),
        ).cast(ASSETS.schema),
    )


# ---------------------------------------------------------------------------
# Characteristics: arrays of (k, v) in page order, a map only at the end
# ---------------------------------------------------------------------------

_NO_PAIRS = "CAST(array() AS ARRAY<STRUCT<k: STRING, v: STRING>>)"
_WS = "[\\\\s\\\\x1c-\\\\x1f]"


def _strip(v: str) -> str:
    return f"regexp_replace({v}, '(?U)^{_WS}+|{_WS}+$', '')"


def _pair(k: str, v: str) -> str:
    return f"named_struct('k', {_strip(k)}, 'v', {_strip(v)})"


def _last_wins(pairs: str) -> str:
    """One entry per key: at its first place, with its last value."""
    return let(pairs, lambda all_: each(
        f"array_distinct({each(all_, lambda e: f'{e}.k')})",
        lambda k: f"try_element_at({where(all_, lambda e: f'{e}.k = {k}')}, -1)"))


def _usable(pairs: str) -> str:
    return _last_wins(where(pairs, lambda e: f"{e}.k <> '' AND {e}.v <> ''"))


def table_characteristics(p: Page) -> str:
    def of_row(row: str) -> str:
        found = lambda own: (
            f"named_struct('k', {first_of(first_text(select(own, ROW_KEYS)))},"
            f" 'v', {first_text(select(own, ROW_VALUES))}, 'cells', {all_texts(select(own, CELL))})")
        pick = lambda r: (
            f"CASE WHEN {r}.k IS NOT NULL THEN {_pair(f'{r}.k', f'{r}.v')}"
            f" WHEN size({r}.cells) >= 2 THEN"
            f" {_pair(f'try_element_at({r}.cells, 1)', f'try_element_at({r}.cells, -1)')} END")
        return let(box(p.nodes, row), lambda own: let(found(own), pick))

    return _usable(each(select(p.nodes, SPEC_ROWS), of_row))


def list_characteristics(p: Page) -> str:
    """One pair per list container."""
    def of_box(n: str) -> str:
        return let(box(p.nodes, n), lambda own: _pair(
            first_text(select(own, LIST_KEYS)), first_text(select(own, LIST_VALUES))))

    return _usable(each(select(p.nodes, SPEC_LISTS), of_box))


def div_characteristics(p: Page) -> str:
    """One pair per block; a key or value element is kept with its markup."""
    def of_box(n: str) -> str:
        return let(box(p.nodes, n), lambda own: _pair(
            first_outer_or_text(select(own, DIV_KEYS), select(own, DIV_KEY_TEXT), p.html),
            first_outer_or_text(select(own, DIV_VALUES), select(own, DIV_VALUE_TEXT), p.html)))

    return _usable(each(select(p.nodes, SPEC_DIVS), of_box))


def _as_text(v: str) -> str:
    """Text of a JSON value; truth values are written with a capital."""
    plain = f"coalesce(try_variant_get({v}, '$', 'string'), to_json({v}))"
    return f"CASE WHEN schema_of_variant({v}) = 'BOOLEAN' THEN initcap({plain}) ELSE {plain} END"


def jsonld_characteristics(p: Page) -> str:
    """``additionalProperty`` pairs, then short top-level texts in their written order."""
    def of_property(x: str) -> str:
        name, value = (f"try_variant_get({x}, '$.{f}', 'variant')" for f in ("name", "value"))
        return let(f"named_struct('k', {name}, 'v', {value})", lambda e: (
            f"CASE WHEN {variant_filled_sql(f'{e}.k')} AND {variant_filled_sql(f'{e}.v')}"
            f" THEN named_struct('k', {_as_text(f'{e}.k')}, 'v', {_as_text(f'{e}.v')}) END"))

    def of_document(doc: str, source: str) -> str:
        listed = each(_array(doc, "$.additionalProperty"), of_property)
        props = where(listed, lambda e: f"{e} IS NOT NULL")
        reserved = ", ".join(map(quoted, LD_RESERVED))
        tops = let(_object(doc), lambda fields: each(
            where(f"json_object_keys({source})", lambda k: (
                f"{k} NOT IN ({reserved}) AND schema_of_variant({fields}[{k}]) = 'STRING'"
                f" AND length(CAST({fields}[{k}] AS STRING)) < 200")),
            lambda k: f"named_struct('k', {k}, 'v', CAST({fields}[{k}] AS STRING))"))
        return f"concat(coalesce({props}, {_NO_PAIRS}), coalesce({tops}, {_NO_PAIRS}))"

    scripts = all_texts(select(p.nodes, LD_SCRIPT))
    found = each(scripts, lambda s: let(parsed_json(s), lambda doc: of_document(doc, s)))
    return _last_wins(f"flatten({found})")


def characteristics(p: Page) -> Column:
    """Table, else list, else blocks; JSON-LD values win where keys clash."""
    listed = first_list(table_characteristics(p), list_characteristics(p), div_characteristics(p))
    return F.expr(_last_wins(f"concat({listed}, {jsonld_characteristics(p)})"))


def characteristics_map(pairs: Column) -> Column:
    return F.map_from_entries(pairs)


def routed(pairs: Column, field: str, convert=text.strip) -> Column:
    """First value that can be converted, of all whose lower-case key is one of the names of the field."""
    hits = F.filter(pairs, lambda e: F.lower(e["k"]).isin(*ROUTES[field]))
    read = F.transform(hits, lambda e: convert(e["v"]))
    return text.first_value(F.filter(read, lambda v: v.isNotNull() & (v.cast("string") != "")))


def special_field(p: Page, pairs: Column, field: str) -> Column:
    """First value whose key contains a keyword of the field, else ``data-<field>``."""
    attr, words = SPECIAL[field]
    pattern = "|".join(words)
    hits = F.filter(pairs, lambda e: F.lower(e["k"]).rlike(pattern))
    fallback = text.strip(F.expr(first_of(first_attr(select(p.nodes, Sel(attr=f"data-{attr}")), f"data-{attr}"))))
    return F.coalesce(F.try_element_at(hits, F.lit(1))["v"], fallback)


def metadata(p: Page, pairs: Column, of_description: Column) -> Column:
    return F.struct(
        F.coalesce(of_description, F.lit("")).alias("__description"),
        *[special_field(p, pairs, field).alias(field) for field in SPECIAL],
        characteristics_map(pairs).alias("characteristics"),
    )


# ---------------------------------------------------------------------------
# Variants
# ---------------------------------------------------------------------------


def is_variant(c: Column) -> Column:
    """A volume or colour, not a clothing size, a fabric or a placeholder."""
    v = F.lower(text.strip(c))
    return F.coalesce(
        (v != "")
        & (F.length(v) <= 100)
        & ~v.rlike("|".join(NOT_A_VARIANT))
        & ~v.isin(*SIZES, *PLACEHOLDERS),
        F.lit(False),
    )


def distinct_variants(values: Column) -> Column:
    """Distinct without regard to case; the first spelling stays."""
    spelled = F.transform(values, lambda v: F.struct(F.lower(text.strip(v)).alias("low"), v.alias("as_is")))
    return F.aggregate(
        spelled,
        F.array().cast("array<struct<low:string,as_is:string>>"),
        lambda kept, v: F.when(F.exists(kept, lambda k: k["low"] == v["low"]), kept).otherwise(
            F.concat(kept, F.array(v))),
        lambda kept: F.transform(kept, lambda k: k["as_is"]),
    )


def _variant_texts(values: Column) -> Column:
    return F.filter(F.transform(values, text.strip), is_variant)


def volume_variants(p: Page) -> Column:
    options, buttons = _texts_of(p, VOLUME_OPTIONS), _texts_of(p, VOLUME_BUTTONS)
    return distinct_variants(_variant_texts(F.expr(f"concat({options}, {buttons})")))


def color_variants(p: Page) -> Column:
    options, buttons = _texts_of(p, COLOR_OPTIONS), _texts_of(p, COLOR_BUTTONS)
    meant = where(options, lambda v: f"(contains(lower({p.url}), 'color') OR contains(lower({v}), 'цвет'))")
    source = let(first_attr(select(p.nodes, COLOR_LIST), "data-available-colors"), parsed_json)
    entries = where(_array(source), lambda v: f"schema_of_variant({v}) = 'STRING'")
    listed = F.filter(F.expr(each(entries, lambda v: f"CAST({v} AS STRING)")), is_variant)
    return distinct_variants(F.concat(
        _variant_texts(F.expr(f"concat({meant}, {buttons})")), F.coalesce(listed, F.expr(_NO_TEXTS))))


def json_variants(p: Page) -> Column:
    """Texts of the entries of ``variants``, else ``options``, else a top-level list."""
    scripts = where(all_texts(select(p.nodes, JSON_SCRIPT)), lambda s: f"contains({s}, 'variants')")
    source = first_of(first_attr(select(p.nodes, VARIANT_LIST), "data-variants"), f"try_element_at({scripts}, 1)")
    return F.expr(let(let(source, parsed_json), lambda doc: each(
        f"coalesce({_array(doc, '$.variants')}, {_array(doc, '$.options')}, {_array(doc)})", _as_text)))


def json_variant_count(texts: Column) -> Column:
    return F.coalesce(F.size(F.filter(texts, is_variant)), F.lit(0))


def variant_count(json_count: Column, volumes: Column, colors: Column) -> Column:
    return F.when(json_count > 0, json_count).otherwise(F.size(F.array_distinct(F.concat(volumes, colors))))


# ---------------------------------------------------------------------------
# The whole product
# ---------------------------------------------------------------------------

# A heading, or a class that names a title; ``&`` may hide the word.
_LOOKS_LIKE_PRODUCT = r"""(?i)<h1|class\s*=\s*(?:"[^"]*(?:title|&)|'[^']*(?:title|&)|[^\s>"']*(?:title|&))"""


def with_nodes(pages: DataFrame, used=None, full_text=("a",)) -> DataFrame:
    """``pages`` plus ``nodes`` and the ``base`` address of each page."""
    parsed = pages.withColumn("nodes", parse_nodes(F.col("html"), used, full_text, [*(used or ()), BASE]))
    return parsed.withColumn("base", base_url())


def product_pages(pages: DataFrame, used: Iterable[Sel] = USED) -> DataFrame:
    """Parsed pages that carry a product heading, for the selectors ``used`` (default: those of all fields).

    The test on the source text runs first: it drops pages that cannot pass
    before any of them reaches Python.
    """
    likely = pages.where(F.col("html").rlike(_LOOKS_LIKE_PRODUCT))
    return with_nodes(likely, [*used, *PRODUCT_MARK]).where(is_product_page(Page()))


def _variant_text(c: Column) -> Column:
    return c.cast("variant")


def product_rows(
    pages: DataFrame,
    scraped_at: Column | int | None = None,
    region: str = "krasnodar",
    source: str | None = None,
) -> DataFrame:
    """One row per product page, with the columns of the product entity.

    ``pages`` has ``url`` and ``html``, and may carry ``category_id`` and
    ``category_name`` of the listing that led to the page.  Rows without a name
    are left out.
    """
    for name in ("category_id", "category_name"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast("string"))
    p = Page()
    picked = product_pages(pages).select(
        "url", "category_id", "category_name", "nodes", "base",
        product_id(p).alias("product_id"), heading(p).alias("heading"),
        volume(p).alias("page_volume"),
        brand(p).alias("brand"), sku(p).alias("sku"),
        breadcrumbs(p).alias("crumbs"), marketing_tags(p).alias("marketing_tags"),
        current_price(p).alias("current"), original_price(p).alias("original"),
        in_stock(p).alias("available"), stock_count(p).alias("count"), stock_status(p).alias("status"),
        main_image(p).alias("main_image"), gallery_images(p).alias("gallery"),
        view_360(p).alias("views"), video_urls(p).alias("videos"),
        description(p).alias("description"), characteristics(p).alias("pairs"),
        rating(p).alias("rating"), review_count(p).alias("review_count"),
        json_variants(p).alias("json_variants"),
        volume_variants(p).alias("volumes"), color_variants(p).alias("colors"),
    )
    joined = picked.select(
        "*",
        title(F.col("heading"), F.col("page_volume")).alias("full_title"),
        metadata(p, F.col("pairs"), F.col("description")).alias("meta"),
        price_data(F.col("current"), F.col("original")).alias("price_data"),
        stock_data(F.col("available"), F.col("count"), F.col("status")).alias("stock_data"),
        assets(F.col("main_image"), F.col("gallery"), F.col("views"), F.col("videos")).alias("assets"),
        variant_count(json_variant_count(F.col("json_variants")), F.col("volumes"), F.col("colors")).alias("variants"),
    )
    entries = F.filter(
        F.array(
            F.struct(F.lit("marketing_tags").alias("key"), F.when(
                F.size("marketing_tags") > 0, F.to_variant_object(F.col("marketing_tags"))).alias("value")),
            F.struct(F.lit("__description").alias("key"), _variant_text(F.col("meta.__description")).alias("value")),
            *[F.struct(F.lit(f).alias("key"), _variant_text(F.col(f"meta.{f}")).alias("value")) for f in SPECIAL],
            F.struct(F.lit("characteristics").alias("key"),
                     F.to_variant_object(F.col("meta.characteristics")).alias("value")),
            F.struct(F.lit("variants_count").alias("key"), F.when(
                F.col("variants") > 0, F.col("variants").cast("variant")).alias("value")),
        ),
        lambda e: e["value"].isNotNull(),
    )
    crumb = F.try_element_at(F.col("crumbs"), F.lit(-1))
    some = lambda c: F.nullif(text.strip(c), F.lit(""))
    have = {
        "product_id": some(F.col("product_id")),
        "name": text.settled(F.nullif(text.clean_title(F.col("full_title")), F.lit(""))),
        "category_id": some(F.col("category_id")),
        "category": F.coalesce(some(crumb), some(F.col("category_name"))),
        "price_data": F.col("price_data"),
        "price": F.col("price_data.current"),
        "original_price": F.col("price_data.original"),
        "discount_percentage": text.calculate_discount(F.col("price_data.original"), F.col("price_data.current")),
        "volume": some(routed(F.col("pairs"), "volume")),
        "alcohol_content": routed(F.col("pairs"), "alcohol_content", text.extract_float),
        "brand": F.nullif(text.clean_title(F.col("brand")), F.lit("")),
        "country": some(routed(F.col("pairs"), "country")),
        "year": F.nullif(routed(F.col("pairs"), "year", text.extract_number).cast("string"), F.lit("0")),
        "description": F.nullif(F.col("description"), F.lit("")),
        "stock_data": F.col("stock_data"),
        "in_stock": F.col("stock_data.in_stock"),
        "stock_quantity": F.col("stock_data.count"),
        "availability_status": some(F.col("stock_data.status")),
        "rating": F.col("rating"),
        "review_count": F.col("review_count"),
        "assets": F.col("assets"),
        "image_url": some(F.col("assets.main_image")),
        "image_urls": F.when(F.size("assets.gallery_images") > 0, F.col("assets.gallery_images")),
        "region": F.lit(region),
        "product_url": F.col("url"),
        "sku": some(F.col("sku")),
        "scraped_at": F.unix_timestamp() if scraped_at is None else scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at),
        "source": F.lit(source),
        "marketing_tags": F.col("marketing_tags"),
        "attributes": F.map_from_entries(entries),
    }
    columns = [
        have.get(n, F.lit(None)).cast(t).alias(n) for n, t, _ in PRODUCT.fields
    ]
    return joined.select(*columns, F.array_distinct(F.concat("volumes", "colors")).alias("variant_names"),
                         F.col("variants").alias("variants_count")).where(F.col("name").isNotNull())

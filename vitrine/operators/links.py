"""Listing pages: product links, next pages, categories and selector checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions import text
from vitrine.functions.nodes import (
    PageNodes, Sel, all_attrs, all_texts, box, each, first_attr, first_list, first_of, let, parse_nodes, select, where,
)
from vitrine.operators.extract import BASE, base_url
from vitrine.sources.scratch import remove_path, write_step

# Where links are looked for, in order.
LINKS = (Sel("a", cls="product-link"), Sel("a", cls="catalog-product"))
CARDS = (Sel("div", cls="product-card"), Sel("div", cls="product-item"), Sel("div", cls_has=("product",)))
ANCHOR = Sel("a")
NEXT = (Sel("a", cls="next-page"), Sel("a", attr="rel", eq="next"), Sel("a", contains="Следующая"))
LAST_PAGE = Sel("a", cls="pagination-link", is_last=True)
CARD, CARD_NAME, CARD_PRICE, CARD_IMAGE = (
    Sel(cls="product-item"), Sel(cls="product-name"), Sel(cls="product-price"), Sel(cls="product-image"))
CATEGORY_LINK = Sel(cls="category-link")

LISTING_USED = (*LINKS, *CARDS, ANCHOR, *NEXT, LAST_PAGE, BASE)


def product_links(nodes: PageNodes = PageNodes("nodes")) -> Column:
    """Links to products as written: two link classes, else the first link of each card."""
    def first_link(card: str) -> str:
        return first_attr(select(box(nodes, card), ANCHOR), "href")

    from_cards = where(each(select(nodes, CARDS), first_link), lambda u: f"{u} <> ''")
    return F.expr(first_list(*[all_attrs(select(nodes, s), "href") for s in LINKS], from_cards))


def next_page(nodes: PageNodes = PageNodes("nodes"), url: str = "url") -> Column:
    """Link to the next listing page as written, or null."""
    last = first_attr(select(nodes, LAST_PAGE), "href")
    usable = let(last, lambda u: (
        f"CASE WHEN contains({url}, 'page') AND NOT contains({url}, {u}) THEN {u} END"))
    return F.expr(first_of(*[first_attr(select(nodes, s), "href") for s in NEXT], usable))


def listing_pages(pages: DataFrame) -> DataFrame:
    """Pages with ``links`` and ``next_url``, both absolute."""
    parsed = pages.withColumn("nodes", parse_nodes(F.col("html"), LISTING_USED))
    found = parsed.select(
        *pages.columns, base_url().alias("base"), product_links().alias("hrefs"), next_page().alias("next_href"))
    return found.select(
        *pages.columns,
        F.transform("hrefs", lambda h: text.resolve_url(F.col("base"), h)).alias("links"),
        text.settled(text.resolve_url(F.col("base"), F.col("next_href"))).alias("next_url"),
    )


def link_rows(listing: DataFrame) -> DataFrame:
    """One row per link: page columns without the page source, position and address."""
    kept = [c for c in listing.columns if c not in ("html", "links", "next_url")]
    return exploded(listing.select(*kept, F.posexplode_outer("links").alias("position", "link_url")), "position")


def exploded(rows: DataFrame, mark: str) -> DataFrame:
    """Drop the null rows of an outer explode.

    A plain explode makes Spark test the array for emptiness first, and that
    test is pushed down with the whole expression that built the array, which is
    then evaluated twice.
    """
    return rows.where(F.col(mark).isNotNull())


def fetch_once(links: DataFrame, *order: str) -> DataFrame:
    """The first request of each address; ``order`` says which comes first.

    An aggregate, not a window: a link that stands on a third of all pages is
    reduced to one row per map task before the shuffle.
    """
    rest = F.struct(*[F.col(c) for c in links.columns])
    return links.groupBy("link_url").agg(
        F.min_by(rest, F.struct(*order)).alias("row")).select("row.*")


def attribute_pages(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """Product pages with the category of the listing that asked for them.

    ``requests`` has one row per ``link_url`` (see :func:`fetch_once`), so the
    join never multiplies rows.
    """
    carried = requests.select(F.col("link_url").alias("url"), "category_id", "category_name")
    return pages.join(carried, "url", "left")


def page_depth(seeds: DataFrame, next_links: DataFrame) -> DataFrame:
    """Page number of every listing page reachable from the seeds.

    ``seeds(url, ...)`` are page 1 and ``next_links(url, next_url)`` the next
    links; of several next links of one page the smallest counts.  Further
    columns of the seeds, such as the category, travel along with the page
    number of the nearest seed (of equally near ones: the smallest values).
    Chains are doubled: after k rounds a jump covers 2^k pages, so a chain of a
    million pages takes 20 rounds of equi-joins and no depth limit is needed.
    A page reached twice keeps its lowest number, which also ends on cycles.
    """
    spark = seeds.sparkSession
    carried = [c for c in seeds.columns if c != "url"]

    def nearest(rows: DataFrame) -> DataFrame:
        if not carried:
            return rows.groupBy("url").agg(F.min("page").alias("page"))
        return rows.groupBy("url").agg(F.min(F.struct("page", *carried)).alias("first")).select("url", "first.*")

    def step_table(df: DataFrame, *done: str) -> tuple[str, DataFrame]:
        """Write a step, then remove the steps that only it has read."""
        path = write_step(df)
        for old in done:
            remove_path(spark, old)
        return path, spark.read.schema(df.schema).parquet(path)

    reach_at, reach = step_table(nearest(seeds.select("url", F.lit(1).cast("bigint").alias("page"), *carried)))
    jumps = next_links.where("next_url IS NOT NULL").groupBy("url").agg(F.min("next_url").alias("target"))
    jumps_at, jumps = step_table(jumps.select(F.col("url").alias("origin"), "target"))
    step, known = 1, reach.count()
    while True:
        further = reach.join(jumps, F.col("url") == F.col("origin")).select(
            F.col("target").alias("url"), (F.col("page") + step).alias("page"), *carried)
        reach_at, reach = step_table(nearest(reach.unionByName(further)), reach_at)
        reached = reach.count()
        if reached == known:
            remove_path(spark, jumps_at)
            return reach
        known, step = reached, step * 2
        onward = jumps.select(F.col("origin").alias("via"), F.col("target").alias("goal"))
        jumps_at, jumps = step_table(jumps.join(onward, F.col("target") == F.col("via")).select(
            "origin", F.col("goal").alias("target")), jumps_at)


def with_seed_category(listing: DataFrame, depth: DataFrame) -> DataFrame:
    """Listing pages with ``page`` and what :func:`page_depth` carried from the seed of their chain."""
    return listing.drop(*[c for c in depth.columns if c != "url"]).join(depth, "url", "left")


def listing_cards(pages: DataFrame) -> DataFrame:
    """One row per product card: id, name, price, image, category."""
    used = (CARD, CARD_NAME, CARD_PRICE, CARD_IMAGE, Sel(attr="data-product-id"), Sel(attr="data-category"))
    kept = [c for c in pages.columns if c != "html"]
    parsed = pages.select(*kept, parse_nodes(F.col("html"), used).alias("nodes"))
    own = each(select(PageNodes("nodes"), CARD), lambda card: (
        f"named_struct('idx', {card}.idx, 'own', {box('nodes', card)})"))
    cards = exploded(parsed.select(*kept, F.explode_outer(F.expr(own)).alias("card")), "card").select(
        *kept, "card.idx",
        F.expr(all_attrs("card.own", "data-product-id")).alias("ids"),
        F.expr(all_texts(select("card.own", CARD_NAME))).alias("names"),
        F.expr(all_texts(select("card.own", CARD_PRICE))).alias("prices"),
        F.expr(all_attrs(select("card.own", CARD_IMAGE), "src")).alias("images"),
        F.expr(all_attrs("card.own", "data-category")).alias("categories"),
    )
    return cards.select(
        *kept, F.col("idx").alias("card"),
        text.take_first(F.transform("ids", text.strip)).alias("product_id"),
        text.take_first(F.transform("names", text.clean_title)).alias("name"),
        text.take_first(F.transform("prices", text.parse_price)).alias("price"),
        text.take_first(F.transform("images", text.strip)).alias("image_url"),
        text.take_first(F.transform("categories", text.strip)).alias("category"),
    )


def category_links(pages: DataFrame, region: str) -> DataFrame:
    """One row per category link: first text, address as written, region."""
    kept = [c for c in pages.columns if c != "html"]
    parsed = pages.select(*kept, parse_nodes(
        F.col("html"), (CATEGORY_LINK, Sel(attr="href"))).alias("nodes"))
    found = each(select(PageNodes("nodes"), CATEGORY_LINK), lambda c: (
        f"named_struct('name', {c}.inner.text, 'url', "
        f"{first_attr(box('nodes', c), 'href')})"))
    return exploded(parsed.select(*kept, F.explode_outer(F.expr(found)).alias("c")), "c").select(
        *kept, "c.name", "c.url", F.lit(region).alias("region"))


# ---------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------

# Named selectors of product and listing pages; the last part says
# what is taken (text, an attribute, or all of them).
PRODUCT_CHECKS = {
    "Title (h1.product-title)": (Sel("h1", cls="product-title"), "text"),
    "Title (h1)": (Sel("h1"), "text"),
    "Title (.product-name)": (Sel(cls="product-name"), "text"),
    "Brand (.product-brand)": (Sel(cls="product-brand"), "text"),
    "Brand (span.brand)": (Sel("span", cls="brand"), "text"),
    "Brand ([data-brand])": (Sel(attr="data-brand"), "data-brand"),
    "Price (.price)": (Sel(cls="price"), "text"),
    "Price (span.product-price)": (Sel("span", cls="product-price"), "text"),
    "Price ([data-price])": (Sel(attr="data-price"), "data-price"),
    "Main Image (.product-image img)": (Sel("img", within=Sel(cls="product-image")), "src"),
    "Gallery Images (.gallery img)": (Sel("img", within=Sel(cls="gallery")), "all src"),
    "Main Image (.main-img)": (Sel(cls="main-img"), "src"),
    "Stock Status (.stock-status)": (Sel(cls="stock-status"), "text"),
    "In Stock (.in-stock)": (Sel(cls="in-stock"), "class"),
    "Stock Count ([data-stock])": (Sel(attr="data-stock"), "data-stock"),
    "Description (.description)": (Sel(cls="description"), "text"),
    "Description (span.desc)": (Sel("span", cls="desc"), "text"),
    "Breadcrumbs (.breadcrumb a)": (Sel("a", within=Sel(cls="breadcrumb")), "all text"),
    "Category (.category)": (Sel(cls="category"), "text"),
}
CATEGORY_CHECKS = {
    "Product Links (a.product-link)": (Sel("a", cls="product-link"), "all href"),
    "Product Links (.product-card a)": (Sel("a", within=Sel(cls="product-card")), "all href"),
    "Product Links (.catalog-product a)": (Sel("a", within=Sel(cls="catalog-product")), "all href"),
    "Next Page (a.next)": (Sel("a", cls="next"), "href"),
    "Next Page (.pagination a.next)": (Sel("a", cls="next", within=Sel(cls="pagination")), "href"),
    "Next Page (a[rel=next])": (Sel("a", attr="rel", eq="next"), "href"),
}


def _hit(sel: Sel, take: str, nodes: PageNodes = PageNodes("nodes")) -> Column:
    """Whether the selector finds something: a first value that is not empty, or any of all."""
    found = select(nodes, sel)
    many, take = take.startswith("all "), take.removeprefix("all ")
    if many:
        values = all_texts(found) if take == "text" else all_attrs(found, take)
        return F.expr(f"size({values}) > 0")
    if take == "text":
        value = f"array_min(flatten({each(found, lambda n: f'{n}.texts')})).text"
    else:
        value = first_attr(found, take)
    return F.expr(f"coalesce({value} <> '', false)")


def selector_coverage(pages: DataFrame, checks: dict[str, tuple[Sel, str]]) -> DataFrame:
    """Per named selector: pages where it finds something, pages, whether it ever does.

    One aggregate over all pages, one counter per selector.
    """
    parsed = pages.select(parse_nodes(F.col("html"), [s for s, _ in checks.values()]).alias("nodes"))
    counts = parsed.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(_hit(*check)).alias(f"c{i}") for i, check in enumerate(checks.values())])
    body = ", ".join("'" + name.replace("'", "\\'") + f"', c{i}, n" for i, name in enumerate(checks))
    rows = counts.select(F.expr(f"stack({len(checks)}, {body}) AS (selector, found, total)"))
    return rows.withColumn("is_missing", F.col("found") == 0)


def out_of_bounds(rows: DataFrame, amount: str | Column, low: int, high: int) -> DataFrame:
    """Rows whose output count breaks the contract ``low..high``."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return rows.where(~c.between(low, high))


def crawl_counters(listing: DataFrame) -> DataFrame:
    """Products found, pages read, and categories finished (no next page)."""
    return listing.agg(
        F.coalesce(F.sum(F.size("links")), F.lit(0)).cast("bigint").alias("products_found"),
        F.count(F.lit(1)).alias("pages_parsed"),
        F.count_if(F.col("next_url").isNull()).alias("categories_parsed"),
    )

"""Queries over page nodes, listing pages and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.nodes import (
    Sel, all_attrs, all_texts, first_attr, first_list, first_of, first_text, outer_html, parse_nodes, select,
)
from vitrine.functions.text import resolve_url
from vitrine.operators import extract, links
from vitrine.plans.registry import register
from vitrine.plans.shapes import SHOP, listing_pages, pages, product_pages, table

_ANCHORS = Sel("a")


@register("page_nodes", "H1", """
    SELECT page_id, len(regexp_extract_all(html, '<[a-zA-Z]'))::INT AS node_count,
      len(regexp_extract_all(html, '<p>'))::INT AS paragraphs, len(regexp_extract_all(html, '<li>'))::INT AS list_items FROM pages""")
def page_nodes(spark, sf):
    parsed = pages(spark, sf).select("page_id", parse_nodes(F.col("html")).alias("nodes"))
    return parsed.select(
        "page_id", (F.size("nodes") - 1).alias("node_count"),
        F.expr(f"size({select('nodes', Sel('p'))})").alias("paragraphs"),
        F.expr(f"size({select('nodes', Sel('li'))})").alias("list_items"))


@register("selected_nodes", "H2", """
    SELECT page_id, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), '|') AS hrefs,
      regexp_extract(html, '<div class="ad">.*?</div>', 0, 's') AS ad, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
      regexp_extract(html, '<a href="([^"]*)"', 1) AS first_href,
      list_last(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS last_href,
      CASE WHEN contains(html, 'href="/the"') THEN '/the' END AS the_href, 0 AS missing FROM pages""")
def selected_nodes(spark, sf):
    nav = Sel("nav")
    first, last = Sel("li", is_first=True, within=nav), Sel("li", is_last=True, within=nav)
    used = (Sel("a", within=nav), Sel("div", cls="ad"), Sel("html", attr="lang"), first, last, Sel("a", attr="href", eq="/the"))
    parsed = pages(spark, sf).select("page_id", "html", parse_nodes(F.col("html"), used).alias("nodes"))
    ad = f"try_element_at({select('nodes', Sel('div', cls='ad'))}, 1)"
    return parsed.select(
        "page_id", F.array_join(F.expr(all_attrs(select("nodes", used[0]), "href")), "|").alias("hrefs"),
        F.expr(outer_html(ad, "html")).alias("ad"),
        F.expr(first_attr(select("nodes", used[2]), "lang")).alias("lang"),
        F.expr(first_attr(select("nodes", Sel("a", within=first)), "href")).alias("first_href"),
        F.expr(first_attr(select("nodes", Sel("a", within=last)), "href")).alias("last_href"),
        F.expr(first_attr(select("nodes", used[5]), "href")).alias("the_href"),
        F.expr(f"size({select('nodes', Sel(cls_has=('product',)))})").alias("missing"))


_PLAIN = "replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@register("fallback_text", "H3", f"""
    SELECT page_id, {_PLAIN.format("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS title,
      array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), '|') AS names FROM pages""")
def fallback_text(spark, sf):
    title, name, head = Sel(cls="product-title"), Sel(cls="product-name"), Sel("h1")
    crumb, item = Sel("a", within=Sel(cls="breadcrumb")), Sel("a", within=Sel("li"))
    parsed = pages(spark, sf).select(
        "page_id", parse_nodes(F.col("html"), (title, name, head, crumb, item)).alias("nodes"))
    return parsed.select(
        "page_id", F.expr(first_of(*[first_text(select("nodes", s)) for s in (title, name, head)])).alias("title"),
        F.expr("array_join(transform({}, t -> concat('/', t)), '|')".format(
            first_list(*[all_texts(select("nodes", s)) for s in (crumb, item)]))).alias("names"))


def _page_links(spark, sf):
    parsed = pages(spark, sf).select("page_id", "url", parse_nodes(F.col("html"), (_ANCHORS,)).alias("nodes"))
    hrefs = links.exploded(parsed.select("page_id", "url", F.posexplode_outer(
        F.expr(all_attrs(select("nodes", _ANCHORS), "href"))).alias("position", "href")), "position")
    return hrefs.select("page_id", "position", resolve_url(F.col("url"), F.col("href")).alias("link_url"))


_RESOLVED = """SELECT page_id, regexp_extract(url, '^https?://[^/?#]*') ||
    unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link_url FROM pages"""


@register("resolved_links", "H5", _RESOLVED)
def resolved_links(spark, sf):
    return _page_links(spark, sf).select("page_id", "link_url")


@register("links_fetched_once", "H5", f"SELECT link_url, min(page_id) AS page_id FROM ({_RESOLVED}) GROUP BY 1")
def links_fetched_once(spark, sf):
    return links.fetch_once(_page_links(spark, sf), "page_id", "position").select("link_url", "page_id")


@register("product_links", "H4", f"""
    SELECT p_partkey AS page_id, CASE WHEN p_partkey % 4 < 3 THEN
      '{SHOP}/product/' || p_partkey || '/|{SHOP}/product/' || (p_partkey + 1) || '/' ELSE '' END AS links FROM part""")
def product_links(spark, sf):
    return links.listing_pages(listing_pages(spark, sf)).select("page_id", F.array_join("links", "|").alias("links"))


@register("next_pages", "H6", f"""
    SELECT p_partkey AS page_id, CASE WHEN p_partkey % 50 <> 49 THEN '{SHOP}/page/' || (p_partkey + 1) END AS next_url FROM part""")
def next_pages(spark, sf):
    return links.listing_pages(listing_pages(spark, sf)).select("page_id", "next_url")


def _category_seeds(spark, sf):
    return listing_pages(spark, sf).where("category_id IS NOT NULL").select("url", "category_id", "category_name")


@register("attributed_pages", "H7", """
    WITH l AS (SELECT p_partkey AS page_id, unnest([p_partkey, p_partkey + 1]) AS target FROM part WHERE p_partkey % 4 < 3),
      f AS (SELECT target, min(page_id) AS page_id FROM l GROUP BY 1)
    SELECT c.p_partkey AS product, p.p_type AS category_name, CAST(p.p_size AS VARCHAR) AS category_id
    FROM part c LEFT JOIN f ON target = c.p_partkey LEFT JOIN part p ON p.p_partkey = f.page_id - f.page_id % 50""")
def attributed_pages(spark, sf):
    listing = links.listing_pages(listing_pages(spark, sf)).select("page_id", "url", "links", "next_url")
    listing = links.with_seed_category(
        listing, links.page_depth(_category_seeds(spark, sf), listing.select("url", "next_url")))
    requests = links.fetch_once(links.link_rows(listing), "page_id", "position")
    goods = table(spark, sf, "part").selectExpr(
        "p_partkey AS product", f"concat('{SHOP}/product/', p_partkey, '/') AS url")
    return links.attribute_pages(goods, requests).select("product", "category_name", "category_id")


@register("page_depth", "H8", f"""
    WITH RECURSIVE d(k, page, category_id, category_name) AS (
      SELECT p_partkey, 1, CAST(p_size AS VARCHAR), p_type FROM part WHERE p_partkey % 50 = 0
      UNION ALL SELECT k + 1, page + 1, category_id, category_name FROM d
        WHERE k % 50 <> 49 AND k + 1 <= (SELECT max(p_partkey) FROM part))
    SELECT '{SHOP}/page/' || k AS url, page::BIGINT AS page, category_id, category_name FROM d""")
def page_depth(spark, sf):
    listing = links.listing_pages(listing_pages(spark, sf)).select("page_id", "url", "next_url")
    return links.page_depth(_category_seeds(spark, sf), listing.select("url", "next_url"))


@register("likely_products", "H9", "SELECT p_partkey AS page_id FROM part WHERE p_partkey % 20 <> 19")
def likely_products(spark, sf):
    return extract.product_pages(product_pages(spark, sf), ()).select("page_id")


@register("headed_pages", "H9", "SELECT page_id FROM pages WHERE contains(html, '<h1>')")
def headed_pages(spark, sf):
    return extract.product_pages(pages(spark, sf)).select("page_id")


@register("listing_cards", "H10", """
    SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS product_id, p_name || ' x' AS name, p_retailprice AS price,
      '/i/' || p_partkey || '.jpg' AS image_url, p_type AS category FROM part, (VALUES (1), (2)) AS twice(n)""")
def listing_cards(spark, sf):
    made = listing_pages(spark, sf).select("page_id", F.col("card_html").alias("html"))
    return links.listing_cards(made).drop("card")


@register("category_links", "H11", """
    SELECT p_partkey AS page_id, p_type AS name, '/category/' || p_type AS url, 'krasnodar' AS region FROM part""")
def category_links(spark, sf):
    made = listing_pages(spark, sf).select("page_id", F.col("menu_html").alias("html"))
    return links.category_links(made, "krasnodar")


@register("selector_coverage", "H12", """
    WITH n AS (SELECT count(*) AS total, count(*) FILTER (contains(html, '<h1>')) AS h1 FROM pages),
      s AS (SELECT unnest(['Title (h1.product-title)', 'Title (h1)', 'Title (.product-name)', 'Brand (.product-brand)', 'Brand (span.brand)',
        'Brand ([data-brand])', 'Price (.price)', 'Price (span.product-price)', 'Price ([data-price])', 'Main Image (.product-image img)',
        'Gallery Images (.gallery img)', 'Main Image (.main-img)', 'Stock Status (.stock-status)', 'In Stock (.in-stock)',
        'Stock Count ([data-stock])', 'Description (.description)', 'Description (span.desc)', 'Breadcrumbs (.breadcrumb a)',
        'Category (.category)']) AS selector)
    SELECT selector, CASE WHEN selector = 'Title (h1)' THEN h1 ELSE 0 END AS found, total, selector <> 'Title (h1)' AS is_missing
    FROM s, n""")
def selector_coverage(spark, sf):
    return links.selector_coverage(pages(spark, sf), links.PRODUCT_CHECKS)


@register("product_selector_coverage", "H12", """
    WITH p AS (SELECT p_partkey % 4 AS l FROM part WHERE p_partkey % 20 <> 19),
      n AS (SELECT (SELECT count(*) FROM part) AS total, count(*) FILTER (l = 0) AS l0, count(*) FILTER (l = 1) AS l1,
        count(*) FILTER (l = 2) AS l2, count(*) FILTER (l <> 2) AS heads FROM p),
      r AS (SELECT 'Title (h1.product-title)' AS selector, l0 AS found FROM n UNION ALL SELECT 'Title (h1)', heads FROM n
        UNION ALL SELECT 'Title (.product-name)', l2 FROM n UNION ALL SELECT 'Brand ([data-brand])', l1 FROM n
        UNION ALL SELECT 'Price ([data-price])', l2 FROM n UNION ALL SELECT 'Stock Status (.stock-status)', l0 FROM n
        UNION ALL SELECT 'In Stock (.in-stock)', l1 FROM n UNION ALL SELECT 'Breadcrumbs (.breadcrumb a)', l0 FROM n)
    SELECT selector, found, total, false AS is_missing FROM r, n""")
def product_selector_coverage(spark, sf):
    return links.selector_coverage(product_pages(spark, sf), links.PRODUCT_CHECKS).where("NOT is_missing")


@register("listing_selector_coverage", "H12", """
    WITH n AS (SELECT count(*) AS total, count(*) FILTER (p_partkey % 4 = 0) AS l0, count(*) FILTER (p_partkey % 4 = 2) AS l2,
      count(*) FILTER (p_partkey % 50 <> 49 AND p_partkey % 3 = 1) AS r FROM part)
    SELECT 'Product Links (a.product-link)' AS selector, l0 AS found, total FROM n
    UNION ALL SELECT 'Product Links (.product-card a)', l2, total FROM n UNION ALL SELECT 'Product Links (.catalog-product a)', 0, total FROM n
    UNION ALL SELECT 'Next Page (a.next)', 0, total FROM n UNION ALL SELECT 'Next Page (.pagination a.next)', 0, total FROM n
    UNION ALL SELECT 'Next Page (a[rel=next])', r, total FROM n""")
def listing_selector_coverage(spark, sf):
    return links.selector_coverage(listing_pages(spark, sf), links.CATEGORY_CHECKS).select("selector", "found", "total")


@register("request_bounds", "H13", """
    SELECT p_partkey AS page_id, 0 AS request_count FROM part WHERE p_partkey % 4 = 3 AND p_partkey % 50 = 49""")
def request_bounds(spark, sf):
    counted = links.listing_pages(listing_pages(spark, sf)).select(
        "page_id", (F.size("links") + F.col("next_url").isNotNull().cast("int")).alias("request_count"))
    return links.out_of_bounds(counted, "request_count", 1, 100)


@register("link_bounds", "H13", """
    SELECT page_id, len(regexp_extract_all(html, '<a href="'))::INT AS link_count FROM pages
    WHERE len(regexp_extract_all(html, '<a href="')) NOT BETWEEN 5 AND 6""")
def link_bounds(spark, sf):
    counted = pages(spark, sf).select("page_id", parse_nodes(F.col("html"), (_ANCHORS,)).alias("nodes")).select(
        "page_id", F.expr(f"size({all_attrs(select('nodes', _ANCHORS), 'href')})").alias("link_count"))
    return links.out_of_bounds(counted, "link_count", 5, 6)


@register("crawl_counters", "H14", """
    SELECT (2 * count(*) FILTER (p_partkey % 4 < 3))::BIGINT AS products_found, count(*) AS pages_parsed,
      count(*) FILTER (p_partkey % 50 = 49) AS categories_parsed FROM part""")
def crawl_counters(spark, sf):
    return links.crawl_counters(links.listing_pages(listing_pages(spark, sf)))

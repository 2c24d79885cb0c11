import itertools
import random

from pyspark.sql import functions as F

from vitrine.operators import links


def listing(spark, html, url="https://e.com/c/page/3"):
    df = spark.createDataFrame([(url, html)], "url string, html string").coalesce(1)
    return links.listing_pages(df).collect()[0]


def test_links_and_next_page(spark):
    row = listing(spark, '<a class="product-link" href="/p/1">a</a><a class="product-link" href="2">b</a><a class="next-page" href="?p=4">n</a>')
    assert row["links"] == ["https://e.com/p/1", "https://e.com/c/page/2"] and row["next_url"] == "https://e.com/c/page/3?p=4"
    row = listing(spark, '<div class="product-card"><p><a href="/p/1">a</a></p><a href="/x">x</a></div><div class="some-product"></div>')
    assert row["links"] == ["https://e.com/p/1"] and row["next_url"] is None
    last = '<div><a class="pagination-link" href="{}">1</a></div>'
    assert listing(spark, last.format("/c/page/9"))["next_url"] == "https://e.com/c/page/9"
    assert listing(spark, last.format("/c/page/3"))["next_url"] is None
    assert listing(spark, last.format("/c/page/9"), "https://e.com/c/3")["next_url"] is None
    assert listing(spark, "<a href='/n'>Следующая »</a>")["next_url"] == "https://e.com/n"


def test_fetch_once_keeps_the_first(spark):
    rows = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("w", 5, "c")], "link_url string, page_id int, category_name string")
    got = {r["link_url"]: r["category_name"] for r in links.fetch_once(rows, "page_id").collect()}
    assert got == {"u": "a", "w": "c"}


def depth_by_hand(seeds, edges):
    depth, frontier = {s: 1 for s in seeds}, list(seeds)
    while frontier:
        following = [(edges[u], depth[u] + 1) for u in frontier if u in edges]
        frontier = []
        for u, d in following:
            if u not in depth:
                depth[u] = d
                frontier.append(u)
    return depth


def test_page_depth_against_brute_force(spark):
    rng = random.Random(3)
    edges = {f"n{i}": f"n{rng.randrange(60)}" for i in range(50)}
    edges |= {f"c{i}": f"c{i + 1}" for i in range(37)} | {"c37": "c5", "x": "y"}
    seeds = ["n0", "n7", "c0", "lonely"]
    got = links.page_depth(
        spark.createDataFrame([(s,) for s in seeds], "url string"),
        spark.createDataFrame([*edges.items(), ("c37b", None)], "url string, next_url string"))
    assert {r["url"]: r["page"] for r in got.collect()} == depth_by_hand(seeds, edges)


def test_category_travels_along_the_chain(spark):
    depth = links.page_depth(
        spark.createDataFrame([("a1", "A", "7"), ("b1", "B", None)], "url string, category_name string, category_id string"),
        spark.createDataFrame([("a1", "a2"), ("a2", "a3"), ("a3", "both"), ("b1", "both"), ("both", "end")], "url string, next_url string"))
    assert {r["url"]: (r["page"], r["category_name"], r["category_id"]) for r in depth.collect()} == {
        "a1": (1, "A", "7"), "a2": (2, "A", "7"), "a3": (3, "A", "7"), "b1": (1, "B", None), "both": (2, "B", None), "end": (3, "B", None)}
    listing = spark.createDataFrame([("a3", "x"), ("alone", "y")], "url string, category_id string")
    assert {r["url"]: r["category_id"] for r in links.with_seed_category(listing, depth).collect()} == {"a3": "7", "alone": None}


def test_cards_categories_and_checks(spark):
    page = spark.createDataFrame([("""<div class="product-item" data-product-id="1"><b class="product-name"> A  B </b><i class="product-price">5 ₽</i>
        <img class="product-image" src="/i"></div><div class="product-item"></div><a class="category-link" href="/c"><b>Cat</b></a>""",)], "html string")
    cards = [tuple(r) for r in links.listing_cards(page).drop("card").collect()]
    assert sorted(cards, key=str) == [("1", "A B", 5.0, "/i", None), (None, None, None, None, None)]
    assert [tuple(r) for r in links.category_links(page, "r").collect()] == [("Cat", "/c", "r")]
    found = {r["selector"]: (r["found"], r["total"], r["is_missing"]) for r in links.selector_coverage(page, links.PRODUCT_CHECKS).collect()}
    assert found["Title (.product-name)"] == (1, 1, False) and found["Title (h1)"] == (0, 1, True) and len(found) == 19
    counted = spark.createDataFrame([(1, 0), (2, 5), (3, 101)], "k int, n int")
    assert [r["k"] for r in links.out_of_bounds(counted, "n", 1, 100).orderBy("k").collect()] == [1, 3]


def test_filters_do_not_read_pages_twice(spark):
    pages = spark.range(10).selectExpr("id", "'https://e.com/page' AS url", "'<a rel=\"next\" href=\"/n\">x</a>' AS html")
    plan = links.listing_pages(pages).where("next_url IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.startswith("Filter isnotnull(next_url#")
    rows = links.link_rows(links.listing_pages(pages))
    filters = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in line]
    assert not any("product-link" in line for line in filters)
    assert list(itertools.chain(rows.collect())) == []

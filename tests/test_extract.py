import json

import pytest
from pyspark.sql import functions as F

from vitrine.functions import text
from vitrine.functions.nodes import Sel, _Index
from vitrine.operators import extract as X
from vitrine.plans import shapes

P = X.Page()


def take(spark, html, column, url="https://ex.com/product/12345/"):
    df = X.with_nodes(spark.createDataFrame([(url, html)], "url string, html string").coalesce(1), X.USED)
    return df.select((F.expr(column) if isinstance(column, str) else column).alias("r")).first()["r"]


@pytest.mark.parametrize("html, url, want", [
    ('<div data-product-id="7"></div><input name="product_id" value="8">', "https://e/product/1/", "7"),
    ('<input name="product_id" value="8">', "https://e/product/1/", "8"),
    ("<p>", "https://example.com/product/12345/", "12345"),
    ("<p>", "https://example.com/1/2/abc", "2"),
    ("<p>", "https://example.com/x/abc", "abc")])
def test_product_id(spark, html, url, want):
    assert take(spark, html, X.product_id(P), url) == want


def test_title_and_volume(spark):
    page = '<h1>Vodka 0.5</h1><div data-volume=" 0.5 "></div>'
    assert take(spark, page, X.title(X.heading(P), X.volume(P))) == "Vodka 0.5"
    assert take(spark, '<h1>A</h1><h1 class="product-title">B</h1><span>1 л</span>', X.title(X.heading(P), X.volume(P))) == "B 1 л"
    assert take(spark, "<p>none</p>", X.title(X.heading(P), X.volume(P))) is None


def test_labels(spark):
    assert take(spark, "<div>x1 <label>Артикул</label> A-7</div>", X.sku(P)) == "x1"
    assert take(spark, '<span class="badge">Premium</span><span class="badge">A</span><span class="badge">Limited Edition</span>',
                X.marketing_tags(P)) == ["Premium", "Limited Edition"]
    assert take(spark, '<nav class="breadcrumb"><a>Home</a><a> </a><a> Vodka</a></nav>', X.breadcrumbs(P)) == ["Home", "Vodka"]
    assert take(spark, "<p>", X.breadcrumbs(P)) == []


@pytest.mark.parametrize("html, now, before", [
    ('<b class="price-current">1 299 ₽</b><b class="price-old">2 000 ₽</b>', 1299.0, 2000.0),
    ('<b class="product-price">1299.99 ₽</b><b data-original-price="1500"></b>', 1299.99, 1500.0),
    ('<span class="some-price"><i>5 000</i></span>', 5000.0, None), ("<p>abc", None, None)])
def test_prices(spark, html, now, before):
    assert take(spark, html, X.current_price(P)) == now
    assert take(spark, html, X.original_price(P)) == before


def test_price_data(spark):
    df = spark.createDataFrame([(1000.0, 2000.0), (1000.0, None), (None, 5.0), (1000.0, 1000.0)], "c double, o double")
    rows = [r["d"] for r in df.select(X.price_data(F.col("c"), F.col("o")).alias("d")).collect()]
    assert tuple(rows[0]) == (1000.0, 2000.0, "Скидка 50%", "RUB")
    assert tuple(rows[1]) == (1000.0, 1000.0, None, "RUB") and rows[2] is None and rows[3]["sale_tag"] is None


@pytest.mark.parametrize("html, available, count, status", [
    ('<title>Осталось 5 шт</title><button class="buy-btn">x</button>', True, 5, None),
    ('<div class="in-stock">В наличии</div><i data-stock-count="12"></i>', True, 12, "В наличии"),
    ('<div class="out-of-stock">нет</div><i data-stock-count="x"></i>', False, None, "Нет в наличии"),
    ('<div class="preorder">p</div>', None, None, "Предзаказ"), ('<div class="on-order">p</div>', None, None, "Под заказ"),
    ('<p class="stock-status"> много </p>', None, None, "много")])
def test_stock(spark, html, available, count, status):
    assert take(spark, html, X.in_stock(P)) is available
    assert take(spark, html, X.stock_count(P)) == count
    assert take(spark, html, X.stock_status(P)) == status


def test_images_and_video(spark):
    html = '<div class="product-gallery"><img src="/z.jpg"><img src="a.jpg"><img src="//c/m.jpg"><img src="/z.jpg"><img></div>'
    assert take(spark, html, X.gallery_images(P)) == [
        "https://c/m.jpg", "https://ex.com/product/12345/a.jpg", "https://ex.com/z.jpg"]
    doc = {"mainImage": "/1.png", "n": 4, "items": [{"src": "/2.png"}, {"k": 1}, 3], "imageCount": 7}
    page = f'<script type="application/json">{json.dumps(doc)}</script><script type="application/json">image {{</script>'
    assert take(spark, page, X.images_from_json(P)) == ["/1.png", "/2.png"]
    assert take(spark, '<base href="https://o.com/d/"><img class="main" src="x.png">', X.main_image(P)) == "https://o.com/d/x.png"
    assert take(spark, '<video src="/v"><source src="/s"></video><iframe src="//youtube/e"></iframe><video src="/s"></video>',
                X.video_urls(P)) == ["https://ex.com/s", "https://youtube/e", "https://ex.com/v"]


def pairs(rows):
    return [(r["k"], r["v"]) for r in rows]


def test_characteristics(spark):
    ld = '<script type="application/ld+json">{"additionalProperty":[{"name":"Volume","value":"750ml"},{"name":"x","value":0}],"b":"2","a":"1","url":"u"}</script>'
    assert pairs(take(spark, ld, X.characteristics(P))) == [("Volume", "750ml"), ("b", "2"), ("a", "1")]
    table = '<table class="specs"><tr><td>A</td><td>1</td></tr><tr><td class="x"> </td></tr><tr><th>h</th><td>k</td><td>m</td><td>v</td></tr><tr><td>A</td><td>2</td></tr></table>'
    assert pairs(take(spark, table, X.characteristics(P))) == [("A", "2"), ("k", "v")]
    both = table.replace(">A<", ">b<") + ld
    assert dict(pairs(take(spark, both, X.characteristics(P))))["b"] == "2"
    lists = '<div class="specs-list"><dt>K</dt><dd>V</dd><dt>K2</dt><dd>V2</dd></div>'
    assert pairs(take(spark, lists, X.characteristics(P))) == [("K", "V")]
    blocks = '<div class="feature"><i class="key">K</i><i class="value">V</i></div>'
    assert pairs(take(spark, blocks, X.characteristics(P))) == [('<i class="key">K</i>', '<i class="value">V</i>')]
    assert take(spark, "<p>", X.characteristics(P)) == []


def test_special_field(spark):
    page = '<table class="specs"><tr><td>Объем</td><td>0.75л</td></tr></table><i data-country=" RU "></i>'
    df = X.with_nodes(spark.createDataFrame([("u", page)], "url string, html string"), X.USED).select(
        "*", X.characteristics(P).alias("pairs"))
    row = df.select(*[X.special_field(P, F.col("pairs"), f).alias(f) for f in X.SPECIAL]).first()
    assert (row["volume"], row["country"], row["year"]) == ("0.75л", "RU", None)


@pytest.mark.parametrize("html, count", [
    ("<div data-variants='{\"variants\":[\"v1\",\"v2\"]}'></div>", 2),
    ("<div data-variants='{\"options\":[\"a1\",\"b1\",\"c1\"]}'></div>", 3),
    ("<div data-variants='[\"a1\",\"XL\"]'></div>", 1), ("<div data-variants='nope'></div>", 0), ("<p>", 0),
    ('<script type="application/json">{"variants":[{"value":"500ml"},7]}</script>', 2)])
def test_json_variants(spark, html, count):
    assert take(spark, html, X.json_variant_count(X.json_variants(P))) == count


def test_variants(spark):
    df = spark.createDataFrame([(["500ml", "500ml", "700ml", "500ML"],)], "v array<string>")
    assert df.select(X.distinct_variants(F.col("v"))).first()[0] == ["500ml", "700ml"]
    words = ["500ml", "700ml", "Red", "XL", "Large", "Size M", "Shirt", "одежда", "select", "", "ткань шелк", None, "x" * 101]
    got = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i").select(
        X.is_variant(F.col("w"))).collect()]
    assert got == [True] * 3 + [False] * 10
    colors = '<select name="c" class="color"><option>Red<option>цвет X</select><b data-color="1">Blue</b><i data-available-colors=\'["Blue","Green",5]\'></i>'
    assert take(spark, colors, X.color_variants(P)) == ["цвет X", "Blue", "Green"]
    assert take(spark, colors, X.color_variants(P), "https://e/color/1") == ["Red", "цвет X", "Blue", "Green"]


def test_rows_without_name_are_left_out(spark):
    pages = spark.createDataFrame(
        [("https://e/1", "<h1> </h1>"), ("https://e/2", "<p>x</p>"), ("https://e/3", "<h1>N</h1>")], "url string, html string")
    rows = X.product_rows(pages, scraped_at=1, source="e").collect()
    assert [(r["product_id"], r["name"], r["source"], r["stock_data"], r["assets"]) for r in rows] == [("3", "N", "e", None, None)]


def test_first_value_that_can_be_read_counts(spark):
    pairs = "array(struct('Крепость' AS k, 'крепкий' AS v), struct('ABV' AS k, '40%' AS v), struct('Год' AS k, 'нет' AS v), " \
            "struct('Vintage' AS k, '1999' AS v), struct('Страна' AS k, ' ' AS v), struct('country' AS k, ' RU ' AS v))"
    row = spark.range(1).select(F.expr(pairs).alias("p")).select(
        X.routed(F.col("p"), "alcohol_content", text.extract_float), X.routed(F.col("p"), "year", text.extract_number),
        X.routed(F.col("p"), "country"), X.routed(F.col("p"), "volume")).first()
    assert tuple(row) == (40.0, 1999, "RU", None)


def test_page_title_alone_is_no_product_heading(spark):
    likely = {"<title>x</title><p class=a>": False, "<H1>x</H1>": True, "<b class = 'big product-title'>x</b>": True,
              "<b class=title>x</b>": True, '<b class="a>b title">x</b>': True, '<b class="ti&#116;le">x</b>': True}
    pages = spark.createDataFrame([(h,) for h in likely], "html string")
    assert {r["html"]: r["l"] for r in pages.select("html", F.col("html").rlike(X._LOOKS_LIKE_PRODUCT).alias("l")).collect()} == likely


def _parts(folder, rows):
    """A table ``part`` in one file, as one row group."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    keys = list(range(1, rows + 1))
    pq.write_table(pa.table({
        "p_partkey": pa.array(keys, pa.int64()), "p_name": [f"name {k}" for k in keys],
        "p_brand": [f"Brand#{k % 7}" for k in keys], "p_type": [("LARGE", "SMALL")[k % 2] for k in keys],
        "p_size": pa.array([k % 50 + 1 for k in keys], pa.int32()), "p_retailprice": [900.0 + k / 10 for k in keys],
    }), f"{folder}/part.parquet")


@pytest.mark.parametrize("made", [shapes.product_pages, shapes.listing_pages])
def test_pages_of_one_file_are_dealt_evenly_over_tasks(spark, folder, made):
    _parts(folder, 2000)
    dealt = made(spark, folder).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list("page_id").alias("ids")).collect()
    assert len(dealt) > 8
    assert max(r["n"] for r in dealt) < 2 * min(r["n"] for r in dealt)
    assert sorted(i for r in dealt for i in r["ids"]) == list(range(1, 2001))


def test_the_source_of_a_page_is_tested_where_the_page_was_dealt_to(spark, folder):
    _parts(folder, 200)
    found = X.product_pages(shapes.product_pages(spark, folder), X.CURRENT_USED)
    above, below = found._jdf.queryExecution().optimizedPlan().toString().split("Repartition ")
    assert "RLIKE" in above and "RLIKE" not in below
    assert sorted(r["page_id"] for r in found.collect()) == [k for k in range(1, 201) if k % 20 != 19]


def test_pages_of_an_empty_table(spark, folder):
    _parts(folder, 0)
    assert shapes.product_pages(spark, folder).collect() == []


READ = {
    "ID_USED": X.product_id, "TITLE_USED": lambda p: F.struct(X.heading(p), X.volume(p)), "VOLUME_USED": X.volume,
    "BRAND_USED": X.brand, "SKU_USED": X.sku, "CRUMBS_USED": X.breadcrumbs, "TAGS_USED": X.marketing_tags,
    "CURRENT_USED": X.current_price, "ORIGINAL_USED": X.original_price, "IN_STOCK_USED": X.in_stock,
    "COUNT_USED": X.stock_count, "STATUS_USED": X.stock_status, "MAIN_USED": X.main_image, "VIEWS_USED": X.view_360,
    "VIDEO_USED": X.video_urls, "DESCRIPTION_USED": X.description,
    "SPECIAL_USED": lambda p: F.struct(*[X.special_field(p, X.characteristics(p), f) for f in ("volume", "sku", "product_code")]),
    "VOLUMES_USED": X.volume_variants, "COLORS_USED": X.color_variants, "JSON_VARIANTS_USED": X.json_variants,
    "RATING_USED": lambda p: F.struct(X.rating(p), X.review_count(p)),
}


@pytest.mark.parametrize("used", sorted(READ))
def test_a_field_needs_no_other_selectors_than_its_own(spark, folder, used):
    _parts(folder, 40)
    made = shapes.product_pages(spark, folder)
    values = [
        sorted(((r[0], str(r[1])) for r in X.product_pages(made, sels).select("page_id", READ[used](X.Page())).collect()))
        for sels in (X.USED, getattr(X, used))]
    assert len(values[0]) == 38 and values[0] == values[1]
    assert len(set(getattr(X, used))) < len(set(X.USED)) / 2


def test_class_texts_are_looked_at_once():
    index = _Index([Sel(cls="a"), Sel(cls_has=("b",))])
    assert index._of_class(" a ") == index._of_class(" a ") != index._of_class(" b ")
    index._of_class(f" {'a ' * 200}")
    assert sorted(index.classes) == [" a ", " b "]

"""Inputs of the registered queries, derived by Spark from the given tables.

``part`` becomes dirty product records, product pages and listing pages, so
that the clean source columns are a ground truth the results can be held
against.  Everything scales with the table it is read from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.functions.text import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# Parts that one task makes pages of, at most and at least.
_MOST_PARTS, _LEAST_PARTS = 10_000, 100


def dealt_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part``, its rows dealt evenly over tasks.

    A part is some forty bytes in its file and a page of a thousand to read, so
    a file that is one task to Spark's reader would keep a single core at work.
    """
    parts = table(spark, sf_dir, "part")
    rows = parts.count()
    tasks = max(-(-rows // _MOST_PARTS), min(rows // _LEAST_PARTS, 2 * spark.sparkContext.defaultParallelism), 1)
    return parts.repartition(tasks)


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records with every fault the cleaning chain repairs."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k",
        "CASE WHEN p_partkey % 97 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS product_id",
        """CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 5 = 1
             THEN concat('  ', replace(p_name, ' ', '\\u00A0  \\t'), ' \\n') ELSE p_name END AS name""",
        "CASE WHEN p_partkey % 89 <> 0 THEN concat('https://shop.example/product/', p_partkey, '/') END AS product_url",
        "CASE WHEN p_partkey % 83 = 0 THEN 0L ELSE 1700000000L + p_partkey END AS scraped_at",
        "concat(' ', p_type, '  ') AS category",
        "CASE WHEN p_partkey % 7 <> 3 THEN p_brand END AS brand",
        "concat(p_name, '\\r\\n', p_type, ' \\n ', p_brand) AS description",
        """CASE WHEN p_partkey % 8 <> 5 THEN named_struct(
             'current', CASE WHEN p_partkey % 6 = 0 THEN p_retailprice * 2 ELSE p_retailprice END,
             'original', CASE WHEN p_partkey % 9 = 4 THEN 0D ELSE p_retailprice END,
             'sale_tag', CAST(NULL AS STRING),
             'currency', CASE p_partkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN '' END) END AS price_data""",
        """CASE WHEN p_partkey % 10 <> 7 THEN named_struct(
             'in_stock', CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END,
             'count', CASE WHEN p_partkey % 9 = 0 THEN -p_size WHEN p_partkey % 9 = 1 THEN NULL ELSE p_size END,
             'status', CASE WHEN p_partkey % 4 = 0 THEN 'В наличии' END,
             'available_regions', CAST(NULL AS ARRAY<STRING>)) END AS stock_data""",
        """CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
             WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price""",
        """CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1D
             ELSE p_retailprice + p_size END AS original_price""",
        "CASE WHEN p_partkey % 23 <> 0 THEN (p_partkey % 80) / 10D END AS rating",
        "CAST(p_partkey % 130 - 10 AS INT) AS discount_percentage",
        "CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS INT) END AS review_count",
        "CASE WHEN p_partkey % 5 = 0 THEN 'USD' END AS currency",
        "CASE WHEN p_partkey % 4 = 0 THEN 'msk' END AS region",
        """CASE WHEN p_partkey % 6 <> 1 THEN
             array(concat(p_type, ' '), p_brand, '', concat(' ', p_brand), p_type, 'Apple') END AS marketing_tags""",
        "CASE WHEN p_partkey % 6 <> 2 THEN array('zebra', ' apple ', p_type, 'zebra', CAST(NULL AS STRING)) END AS tags",
        """map('volume', concat('  ', p_size, '  ml '), '', 'x', 'none', CAST(NULL AS STRING),
             'brand', p_brand) AS attributes""",
        """CASE p_partkey % 4 WHEN 0 THEN CAST(array() AS ARRAY<STRING>) WHEN 1 THEN NULL ELSE array(
             concat('/b/', p_partkey), concat('/a/', p_partkey), concat('/b/', p_partkey)) END AS image_urls""",
        """CASE WHEN p_partkey % 5 <> 2 THEN named_struct(
             'main_image', concat('/m/', p_partkey),
             'gallery_images', array(concat('/g/', p_size), '/g/0', concat('/g/', p_size)),
             'view_360', CAST(NULL AS ARRAY<STRING>), 'video', array('/v', '/v'),
             'cached_images', CAST(NULL AS ARRAY<STRING>)) END AS assets""",
    )


# The shop of the derived pages.
SHOP = "https://shop.example"

_PAGE_URL = f"""CASE p_partkey % 4
  WHEN 2 THEN concat('{SHOP}/product/', p_partkey, '/') WHEN 3 THEN concat('{SHOP}/goods/p-', p_partkey)
  ELSE concat('{SHOP}/item') END"""

_RU_PRICE = "replace(format_string('%.2f', {}), '.', ',')"

_HEAD = """concat('<!DOCTYPE html><html>\n<head>\n<title>',
  CASE WHEN p_partkey % 3 = 0 THEN concat('Осталось ', p_size, ' ШТ') ELSE p_name END, '</title>',
  CASE WHEN p_partkey % 4 = 3 THEN concat('<script type="application/ld+json">{"@type":"Product","name":"n",',
    '"zeta":"', p_type, '","additionalProperty":[{"name":"Volume","value":"', p_size, 'ml"},',
    '{"name":"Organic","value":true},{"name":"Rank","value":', p_size, '},{"name":"","value":"x"}],',
    '"brand":"', p_brand, '","stock":7}</script><script type="application/ld+json">not json</script>')
  ELSE '' END, '</head><body>')"""

_LAYOUTS = (
    # 0: full markup, characteristics in a table
    f"""concat('<nav class="breadcrumb"><a href="/">Home</a><a href="/c"> ', p_type, ' </a></nav>',
    '<div data-product-id="', p_partkey, '"><h1 class="product-title"> ', p_name, ' </h1>',
    '<span class="product-volume"> ', p_size, ' мл </span><span class="brand-name"> ', p_brand, ' </span>',
    '<div data-sku=" SKU-', p_partkey, ' "></div><span class="product-tag">', p_type, '</span>',
    '<span class="product-tag">A</span><span class="product-tag"> Hit </span>',
    '<b class="price-current">', {_RU_PRICE.format("p_retailprice")}, ' ₽</b>',
    '<s class="price-old">', {_RU_PRICE.format("p_retailprice + p_size")}, ' ₽</s>',
    '<button class="big buy-btn">Buy</button><i class="stock-status"> Есть </i>',
    '<div class="product-image-main"><img src="/m/', p_partkey, '.jpg"></div>',
    '<div class="product-gallery"><img src="/g/', p_partkey, '-b.jpg"><img src="//cdn.example/', p_partkey,
    '-a.jpg"><img src="/g/', p_partkey, '-b.jpg"></div><a data-360="/v/', p_partkey, '.jpg">360</a>',
    '<video src="/t/', p_partkey, '.mp4"><source src="/s/', p_partkey, '.mp4"></video>',
    '<iframe src="//www.youtube.com/e/', p_partkey, '"></iframe><iframe src="https://vimeo.com/', p_partkey, '"></iframe>',
    '<div class="product-description">\n ', p_name, ' by ', p_brand, ' </div>',
    '<table class="characteristics"><tr><td>ABV</td><td>крепкий</td></tr><tr><td>Vintage</td><td>нет</td></tr>',
    '<tr><td>Объем</td><td>', p_size, ' мл</td></tr>',
    '<tr><td>Крепость</td><td> ', p_size, '.5% </td><tr><td>Страна<td>', p_type,
    '<tr><td>Год</td><td>урожай ', 1990 + p_size, '</td></tr><tr><td>Объем</td><td>', p_size + 1, ' мл</td></tr></table>',
    '<select class="volume-selector"><option>select<option> ', p_size, ' ml<option>', p_size, ' ML<option>Large</select>',
    '<button class="color-btn">Red</button><span class="rating-value">', p_size % 5, '.5 / 5</span>',
    '<span class="review-count">n/a</span><span class="review-count">', p_size, ' отзывов</span></div>')""",
    # 1: plain heading, list characteristics
    f"""concat('<div><input name="product_id" value="', p_partkey, '"><a class="breadcrumb-link">Home</a>',
    '<a class="breadcrumb-link"> </a><a class="breadcrumb-link">', p_type, '</a><h1>', p_name, '</h1>',
    '<p data-volume=" ', p_size, ' мл"></p><i data-brand="', p_brand, '"></i>',
    '<input name="sku" value="SKU-', p_partkey, '"><em class="tag">', p_type, '</em>',
    '<b class="product-price">', format_string('%.2f', p_retailprice), ' ₽</b>',
    '<u data-original-price="', p_retailprice + p_size, '"></u><div class="in-stock">Товар В НАЛИЧИИ</div>',
    '<div data-stock-count="', p_size, '"></div><img class="product-main-image" src="https://cdn.example/m', p_partkey, '.jpg">',
    '<div class="product-carousel"><img src="/c/', p_partkey, '.jpg"></div>',
    '<div class="view-360"><img src="/w/', p_partkey, '.jpg"></div>',
    '<div class="long-description">', p_name, '<b>!</b></div>',
    '<div class="specs-list"><dl><dt>Volume</dt><dd>', p_size, ' мл</dd></dl></div>',
    '<div class="characteristics-list"><span class="label">ABV</span><span class="value">', p_size, '</span></div>',
    '<select name="my-volume"><option>', p_size, ' ml<option>', p_size + 1, ' ml</select>',
    '<select name="color"><option>цвет ', p_brand, '<option>plain</select></div>')""",
    # 2: name only by class, block characteristics
    f"""concat('<div class="product-name title">', p_name, '</div><span>около ', p_size, ' л</span>',
    '<a class="brand-link"> ', p_brand, '</a><div><label>Артикул:</label> SKU-', p_partkey, ' </div>',
    '<i class="hot-badge">', p_type, '</i><div data-price="', p_retailprice, '"></div>',
    '<s class="price-original">', p_retailprice + p_size, '</s>',
    '<div class="out-of-stock">Нет в наличии</div><img class="main-pic" src="x/', p_partkey, '.jpg">',
    '<ul class="gallery-list"><li><img src="../up/', p_partkey, '.jpg"></ul><img data-type="v360" src="/z/', p_partkey, '.jpg">',
    '<div class="description"><p>', p_name, '</p></div>',
    '<div class="feature"><u class="f-label">Country</u><u class="f-content">', p_type, '</u></div>',
    '<div class="feature"><u class="f-label">Страна</u><u class="f-content">other</u></div>',
    '<div data-variants=''{{"variants":["', p_size, ' ml","XL","', p_size, ' l"]}}''></div>')""",
    # 3: fallbacks only, JSON-LD and JSON
    f"""concat('<h1>', p_name, '</h1><span class="the-price"><b>', format_string('%.2f', p_retailprice), '</b></span>',
    '<div class="preorder">скоро</div><div data-main-image="/dm/', p_partkey, '.jpg"></div>',
    '<p class="product-text">', p_name, '</p><u data-code=" C-', p_partkey, '"></u>',
    '<script type="application/json">{{"mainImage":"/j/', p_partkey, '.png","note":"n","list":[{{"src":"/j/', p_size,
    '.png"}},{{"srcset":3}},5],"has_variants":true,"options":["', p_size, ' ml","select"]}}</script>',
    '<div data-available-colors=''["Blue","blue","XL",3]''></div><b class="color-x-btn">Green</b>')""",
)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product page per part, in four layouts; every twentieth is empty."""
    body = "CASE p_partkey % 4 " + " ".join(
        f"WHEN {i} THEN {layout}" for i, layout in enumerate(_LAYOUTS)) + " END"
    made = dealt_parts(spark, sf_dir).selectExpr(
        "p_partkey AS page_id", f"{_PAGE_URL} AS url",
        f"""CASE WHEN p_partkey % 20 = 19 THEN '<html><body><p>gone</p></body></html>'
              ELSE concat({_HEAD}, {body}, '</body></html>') END AS html""",
        "CAST(p_size AS STRING) AS category_id", "concat('meta ', p_type) AS category_name",
    )
    # Made where the parts were dealt to: no test on the source of a page moves below the dealing, into one task.
    return made.withColumn("html", settled(F.col("html")))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per part, in four layouts, chained 50 pages long; only the first of a chain knows its category."""
    target = lambda k: f"'/product/', {k}, '/'"
    links = f"""CASE p_partkey % 4
      WHEN 0 THEN concat('<a class="product-link" href="', {target('p_partkey')}, '">x</a>',
        '<a class="big product-link" href="', {target('p_partkey + 1')}, '">y</a><a class="product-link">z</a>')
      WHEN 1 THEN concat('<a class="catalog-product" href="{SHOP}', {target('p_partkey')}, '">x</a>',
        '<a class="catalog-product" href="', {target('p_partkey + 1')}, '">y</a>')
      WHEN 2 THEN concat('<div class="product-card"><p><a href="', {target('p_partkey')}, '">x</a><a href="/no">n</a></p></div>',
        '<div class="my-product-box"><a href="', {target('p_partkey + 1')}, '">y</a></div><div class="product-item"></div>')
      ELSE '<p>empty</p>' END"""
    onward = f"concat('{SHOP}/page/', p_partkey + 1)"
    following = f"""CASE WHEN p_partkey % 50 = 49 THEN concat(
        '<div><a class="pagination-link" href="/page/1">1</a><a class="pagination-link" href="/page/', p_partkey, '">l</a></div>')
      WHEN p_partkey % 3 = 0 THEN concat('<a class="next-page" href="', {onward}, '">n</a>')
      WHEN p_partkey % 3 = 1 THEN concat('<a rel="next" href="', p_partkey + 1, '">n</a>')
      WHEN p_partkey % 6 = 2 THEN concat('<a href="/page/', p_partkey + 1, '"><b>Следующая</b> страница</a>')
      ELSE concat('<div><a class="pagination-link" href="/page/1">1</a><a class="pagination-link" href="/page/',
        p_partkey + 1, '">l</a></div>') END"""
    cards = """concat('<div class="product-item" data-product-id=" ', p_partkey, '"><b class="product-name"> </b>',
      '<b class="product-name">', p_name, '  x</b><i class="product-price">n/a</i><i class="product-price">',
      format_string('%.1f', p_retailprice), '</i><img class="product-image" src=" /i/', p_partkey, '.jpg ">',
      '<u data-category="', p_type, '"></u></div>')"""
    named = """concat('<a class="category-link" href="/category/', p_type, '"><b>', p_type, '</b> all</a>')"""
    made = dealt_parts(spark, sf_dir).selectExpr(
        "p_partkey AS page_id", f"concat('{SHOP}/page/', p_partkey) AS url",
        f"concat('<html><body>', {links}, {following}, '</body></html>') AS html",
        f"concat('<html><body><ul>', {cards}, '<li>', {cards}, '</ul></body></html>') AS card_html",
        f"concat('<html><body><nav>', {named}, '<a href=\"/x\">x</a></nav></body></html>') AS menu_html",
        "CASE WHEN p_partkey % 50 = 0 THEN CAST(p_size AS STRING) END AS category_id",
        "CASE WHEN p_partkey % 50 = 0 THEN p_type END AS category_name",
    )
    return made


# What the four event types stand for in a crawl log.
KINDS = {"signup": "item", "click": "request", "view": "response", "error": "error", "purchase": "exception"}


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a crawl log; a run is one day of one of three spiders."""
    kinds = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items())
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", f"CASE event_type {kinds} END AS kind",
        "concat('spider-', user_id % 3) AS run", "concat('cat-', user_id % 7) AS category",
        "concat('proxy-', user_id) AS endpoint",
        "CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'success' ELSE 'sent' END AS outcome",
        "CASE WHEN user_id % 5 <> 0 THEN concat('https://shop.example/', event_id) END AS url",
        """CASE CAST(get_json_object(props, '$.k') AS INT) % 5 WHEN 0 THEN 'DNSLookupError' WHEN 1 THEN 'TimeoutError'
             WHEN 2 THEN 'ConnectionRefusedError' WHEN 3 THEN 'HttpError' ELSE 'ValueError' END AS error_type""",
        "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) % 5 = 3 THEN 400 + CAST(get_json_object(props, '$.k') AS INT) END AS status",
        "concat('value ', value) AS message", "value", "event_type",
    )


def price_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as prices over time: the customer is the product, the priority the region."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS snapshot_id", "CAST(o_custkey AS STRING) AS product_id", "o_orderpriority AS region",
        "o_totalprice AS price", "o_orderdate AS at")


def product_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as JSON text with wrong types, missing fields and bad addresses."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS k", """concat('{',
      CASE WHEN p_partkey % 7 <> 0 THEN concat('"product_id":"', p_partkey, '",') ELSE '' END,
      '"name":', CASE WHEN p_partkey % 11 = 0 THEN '""' ELSE concat('"', p_name, '"') END, ',',
      CASE p_partkey % 3 WHEN 0 THEN concat('"product_url":"https://shop.example/', p_partkey, '",')
        WHEN 1 THEN '"product_url":"shop.example/x",' ELSE '' END,
      '"scraped_at":', CASE WHEN p_partkey % 13 = 0 THEN concat('"', p_partkey, '"') ELSE concat('17', p_partkey) END, ',',
      '"price":', CASE WHEN p_partkey % 5 = 0 THEN '-4.5' WHEN p_partkey % 5 = 1 THEN concat('"', p_size, '"')
        ELSE CAST(p_size + 0.5 AS STRING) END, ',',
      '"original_price":', CASE WHEN p_partkey % 4 = 0 THEN '2' ELSE 'null' END, ',',
      '"rating":', CASE WHEN p_partkey % 6 = 0 THEN '-1' ELSE '4.5' END, ',',
      '"review_count":', CASE WHEN p_partkey % 8 = 0 THEN '1.5' ELSE '0' END, ',',
      '"in_stock":', CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END, ',',
      '"marketing_tags":', CASE WHEN p_partkey % 9 = 0 THEN '"hot"' ELSE '["hot"]' END, ',',
      '"image_urls":', CASE WHEN p_partkey % 10 = 0 THEN '{"a":1}' ELSE '[]' END, ',',
      '"image_url":', CASE WHEN p_partkey % 12 = 0 THEN '"/rel"' ELSE 'null' END, '}') AS value""")


def stored_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean product rows as they lie in the store."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.expr("CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END").alias("name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"), (F.col("p_size") % 2 == 0).alias("in_stock"),
        F.expr("""CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(array() AS ARRAY<STRING>)
                    ELSE transform(sequence(1, CAST(p_size AS INT)), i -> concat('/i/', i)) END""").alias("image_urls"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, CAST(p_partkey % 30 AS INT))").alias("created_at"),
    )

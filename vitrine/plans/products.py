"""Queries over product extraction; the truth is the columns the pages were made from."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.text import extract_float, extract_number, strip
from vitrine.operators import extract as X
from vitrine.operators.clean import clean_products
from vitrine.plans.registry import register
from vitrine.plans.shapes import SHOP, pages, product_pages, table

_P = X.Page()
# l is the layout of the page; every twentieth page holds no product.
_FROM = "(SELECT *, p_partkey AS k, p_partkey % 4 AS l FROM part WHERE p_partkey % 20 <> 19) AS p"


def _parsed(spark, sf, used):
    return X.product_pages(product_pages(spark, sf), used).withColumnRenamed("page_id", "k")


def _take(spark, sf, used, **columns):
    return _parsed(spark, sf, used).select("k", *[c.alias(n) for n, c in columns.items()])


def _shown(pairs):
    """Pairs as one text, in order."""
    return F.array_join(F.transform(pairs, lambda e: F.concat_ws("=", e["k"], e["v"])), "; ")


@register("product_ids", "X1", f"SELECT k, CASE WHEN l = 3 THEN 'p-' ELSE '' END || k AS product_id FROM {_FROM}")
def product_ids(spark, sf):
    return _take(spark, sf, X.ID_USED, product_id=X.product_id(_P))


_VOLUME = "CASE WHEN l < 2 THEN p_size || ' мл' WHEN l = 2 THEN 'около ' || p_size || ' л' END"


@register("product_titles", "X2", f"SELECT k, p_name || coalesce(' ' || {_VOLUME}, '') AS title FROM {_FROM}")
def product_titles(spark, sf):
    picked = _take(spark, sf, X.TITLE_USED, heading=X.heading(_P), volume=X.volume(_P))
    return picked.select("k", X.title(F.col("heading"), F.col("volume")).alias("title"))


@register("product_volumes", "X3", f"SELECT k, {_VOLUME} AS volume FROM {_FROM}")
def product_volumes(spark, sf):
    return _take(spark, sf, X.VOLUME_USED, volume=X.volume(_P))


@register("product_brands", "X4", f"SELECT k, CASE WHEN l < 3 THEN p_brand END AS brand FROM {_FROM}")
def product_brands(spark, sf):
    return _take(spark, sf, X.BRAND_USED, brand=X.brand(_P))


@register("product_skus", "X5", f"SELECT k, CASE WHEN l < 3 THEN 'SKU-' || k END AS sku FROM {_FROM}")
def product_skus(spark, sf):
    return _take(spark, sf, X.SKU_USED, sku=X.sku(_P))


@register("breadcrumbs", "X6", f"SELECT k, CASE WHEN l < 2 THEN 'Home|' || p_type ELSE '' END AS crumbs FROM {_FROM}")
def breadcrumbs(spark, sf):
    return _take(spark, sf, X.CRUMBS_USED, crumbs=F.array_join(X.breadcrumbs(_P), "|"))


@register("marketing_tags", "X7", f"""
    SELECT k, CASE WHEN l = 0 THEN p_type || '|Hit' WHEN l < 3 THEN p_type ELSE '' END AS tags FROM {_FROM}""")
def marketing_tags(spark, sf):
    return _take(spark, sf, X.TAGS_USED, tags=F.array_join(X.marketing_tags(_P), "|"))


@register("current_prices", "X8", f"SELECT k, p_retailprice AS price FROM {_FROM}")
def current_prices(spark, sf):
    return _take(spark, sf, X.CURRENT_USED, price=X.current_price(_P))


@register("original_prices", "X9", f"SELECT k, CASE WHEN l < 3 THEN round(p_retailprice + p_size, 2) END AS price FROM {_FROM}")
def original_prices(spark, sf):
    return _take(spark, sf, X.ORIGINAL_USED, price=F.round(X.original_price(_P), 2))


@register("price_data", "X10", f"""
    WITH o AS (SELECT *, CASE WHEN l < 3 THEN round(p_retailprice + p_size, 2) ELSE p_retailprice END AS original FROM {_FROM})
    SELECT k, p_retailprice AS current, original, CASE WHEN trunc((original - p_retailprice) / original * 100) > 0 THEN
      'Скидка ' || trunc((original - p_retailprice) / original * 100)::INT || '%' END AS sale_tag, 'RUB' AS currency FROM o""")
def price_data(spark, sf):
    picked = _take(spark, sf, X.CURRENT_USED + X.ORIGINAL_USED, now=X.current_price(_P), before=X.original_price(_P))
    data = picked.select("k", X.price_data(F.col("now"), F.col("before")).alias("d"))
    return data.select("k", "d.current", F.round("d.original", 2).alias("original"), "d.sale_tag", "d.currency")


_IN_STOCK = "CASE WHEN l < 2 THEN true WHEN l = 2 THEN false END"
_COUNT = "CASE WHEN k % 3 = 0 OR l = 1 THEN p_size END"
_STATUS = "CASE l WHEN 0 THEN 'Есть' WHEN 1 THEN 'В наличии' WHEN 2 THEN 'Нет в наличии' ELSE 'Предзаказ' END"


@register("in_stock", "X11", f"SELECT k, {_IN_STOCK} AS in_stock FROM {_FROM}")
def in_stock(spark, sf):
    return _take(spark, sf, X.IN_STOCK_USED, in_stock=X.in_stock(_P))


@register("stock_counts", "X12", f"SELECT k, {_COUNT} AS stock_count FROM {_FROM}")
def stock_counts(spark, sf):
    return _take(spark, sf, X.COUNT_USED, stock_count=X.stock_count(_P))


@register("stock_status", "X13", f"SELECT k, {_STATUS} AS status FROM {_FROM}")
def stock_status(spark, sf):
    return _take(spark, sf, X.STATUS_USED, status=X.stock_status(_P))


@register("stock_data", "X14", f"""
    SELECT k, coalesce({_IN_STOCK}, true) AS in_stock, coalesce({_COUNT}, 0) AS stock_count, {_STATUS} AS status, 0 AS regions
    FROM {_FROM}""")
def stock_data(spark, sf):
    picked = _take(spark, sf, X.IN_STOCK_USED + X.COUNT_USED + X.STATUS_USED,
                   a=X.in_stock(_P), c=X.stock_count(_P), s=X.stock_status(_P))
    return picked.select("k", X.stock_data(F.col("a"), F.col("c"), F.col("s")).alias("d")).select(
        "k", "d.in_stock", F.col("d.count").alias("stock_count"), "d.status", F.size("d.available_regions").alias("regions"))


_MAIN = f"""CASE l WHEN 0 THEN '{SHOP}/m/' || k || '.jpg' WHEN 1 THEN 'https://cdn.example/m' || k || '.jpg'
  WHEN 2 THEN '{SHOP}/product/' || k || '/x/' || k || '.jpg' ELSE '{SHOP}/dm/' || k || '.jpg' END"""
_GALLERY = f"""CASE l WHEN 0 THEN 'https://cdn.example/' || k || '-a.jpg|{SHOP}/g/' || k || '-b.jpg' WHEN 1 THEN '{SHOP}/c/' || k || '.jpg'
  WHEN 2 THEN '{SHOP}/product/up/' || k || '.jpg' ELSE
    array_to_string(list_sort(list_distinct(['{SHOP}/j/' || k || '.png', '{SHOP}/j/' || p_size || '.png'])), '|') END"""
_VIEWS = f"CASE WHEN l < 3 THEN '{SHOP}/' || ['v', 'w', 'z'][l + 1] || '/' || k || '.jpg' ELSE '' END"
_VIDEOS = f"""CASE WHEN l = 0 THEN '{SHOP}/s/' || k || '.mp4|https://www.youtube.com/e/' || k || '|https://vimeo.com/' || k ||
  '|{SHOP}/t/' || k || '.mp4' ELSE '' END"""


@register("main_images", "X15", f"SELECT k, {_MAIN} AS image FROM {_FROM}")
def main_images(spark, sf):
    return _take(spark, sf, X.MAIN_USED, image=X.main_image(_P))


@register("gallery_images", "X16", f"SELECT k, {_GALLERY} AS images FROM {_FROM}")
def gallery_images(spark, sf):
    return _take(spark, sf, X.GALLERY_USED, images=F.array_join(X.gallery_images(_P), "|"))


@register("json_images", "X17", f"""
    SELECT k, CASE WHEN l = 3 THEN '/j/' || k || '.png|/j/' || p_size || '.png' ELSE '' END AS images FROM {_FROM}""")
def json_images(spark, sf):
    return _take(spark, sf, [X.JSON_SCRIPT], images=F.array_join(F.expr(X.images_from_json(_P)), "|"))


@register("views_360", "X18", f"SELECT k, {_VIEWS} AS images FROM {_FROM}")
def views_360(spark, sf):
    return _take(spark, sf, X.VIEWS_USED, images=F.array_join(X.view_360(_P), "|"))


@register("video_urls", "X19", f"SELECT k, {_VIDEOS} AS videos FROM {_FROM}")
def video_urls(spark, sf):
    return _take(spark, sf, X.VIDEO_USED, videos=F.array_join(X.video_urls(_P), "|"))


@register("assets", "X20", f"""
    SELECT k, {_MAIN} AS main_image, {_GALLERY} AS gallery, {_VIEWS} AS views, {_VIDEOS} AS videos, 0 AS cached FROM {_FROM}""")
def assets(spark, sf):
    picked = _take(spark, sf, X.MAIN_USED + X.GALLERY_USED + X.VIEWS_USED + X.VIDEO_USED,
                   m=X.main_image(_P), g=X.gallery_images(_P), v=X.view_360(_P), w=X.video_urls(_P))
    data = picked.select("k", X.assets(F.col("m"), F.col("g"), F.col("v"), F.col("w")).alias("a"))
    return data.select(
        "k", "a.main_image", F.array_join("a.gallery_images", "|").alias("gallery"), F.array_join("a.view_360", "|").alias("views"),
        F.array_join("a.video", "|").alias("videos"), F.size("a.cached_images").alias("cached"))


_DESCRIPTION = "CASE WHEN l = 0 THEN p_name || ' by ' || p_brand ELSE p_name END"


@register("descriptions", "X21", f"SELECT k, {_DESCRIPTION} AS description FROM {_FROM}")
def descriptions(spark, sf):
    return _take(spark, sf, X.DESCRIPTION_USED, description=X.description(_P))


_TABLE = """CASE WHEN l = 0 THEN 'ABV=крепкий; Vintage=нет; Объем=' || (p_size + 1) || ' мл; Крепость=' || p_size || '.5%; Страна=' || p_type ||
  '; Год=урожай ' || (1990 + p_size) ELSE '' END"""
_LIST = "CASE WHEN l = 1 THEN 'Volume=' || p_size || ' мл; ABV=' || p_size ELSE '' END"
_DIV = "CASE WHEN l = 2 THEN 'Country=' || p_type || '; Страна=other' ELSE '' END"
_LD = """CASE WHEN l = 3 THEN 'Volume=' || p_size || 'ml; Organic=True; Rank=' || p_size || '; zeta=' || p_type || '; brand=' || p_brand
  ELSE '' END"""


@register("table_characteristics", "X22", f"SELECT k, {_TABLE} AS pairs FROM {_FROM}")
def table_characteristics(spark, sf):
    return _take(spark, sf, X.CHARACTERISTICS_USED, pairs=_shown(F.expr(X.table_characteristics(_P))))


@register("list_characteristics", "X23", f"SELECT k, {_LIST} AS pairs FROM {_FROM}")
def list_characteristics(spark, sf):
    return _take(spark, sf, X.CHARACTERISTICS_USED, pairs=_shown(F.expr(X.list_characteristics(_P))))


@register("block_characteristics", "X24", f"SELECT k, {_DIV} AS pairs FROM {_FROM}")
def block_characteristics(spark, sf):
    return _take(spark, sf, X.CHARACTERISTICS_USED, pairs=_shown(F.expr(X.div_characteristics(_P))))


@register("jsonld_characteristics", "X25", f"SELECT k, {_LD} AS pairs FROM {_FROM}")
def jsonld_characteristics(spark, sf):
    return _take(spark, sf, X.CHARACTERISTICS_USED, pairs=_shown(F.expr(X.jsonld_characteristics(_P))))


@register("characteristics", "X26", f"SELECT k, {_TABLE} || {_LIST} || {_DIV} || {_LD} AS pairs FROM {_FROM}")
def characteristics(spark, sf):
    return _take(spark, sf, X.CHARACTERISTICS_USED, pairs=_shown(X.characteristics(_P)))


_ROUTED = {
    "volume": "CASE l WHEN 0 THEN (p_size + 1) || ' мл' WHEN 1 THEN p_size || ' мл' WHEN 3 THEN p_size || 'ml' END",
    "alcohol_content": "CASE l WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size END::DOUBLE",
    "country": "CASE l WHEN 0 THEN p_type WHEN 2 THEN p_type END",
    "year": "CASE WHEN l = 0 THEN 1990 + p_size END::BIGINT",
}


@register("routed_characteristics", "X27", f"SELECT k, {', '.join(f'{v} AS {n}' for n, v in _ROUTED.items())} FROM {_FROM}")
def routed_characteristics(spark, sf):
    picked = _take(spark, sf, X.CHARACTERISTICS_USED, pairs=X.characteristics(_P))
    read = {"alcohol_content": extract_float, "year": extract_number}
    return picked.select("k", *[X.routed(F.col("pairs"), n, read.get(n, strip)).alias(n) for n in _ROUTED])


_SPECIAL = _ROUTED | {
    "alcohol_content": "CASE l WHEN 0 THEN 'крепкий' WHEN 1 THEN CAST(p_size AS VARCHAR) END",
    "year": "CASE WHEN l = 0 THEN 'нет' END",
    "sku": "CASE WHEN l = 0 THEN 'SKU-' || k END", "product_code": "CASE WHEN l = 3 THEN 'C-' || k END"}


@register("special_fields", "X28", f"SELECT k, {', '.join(f'{v} AS {n}' for n, v in _SPECIAL.items())} FROM {_FROM}")
def special_fields(spark, sf):
    picked = _parsed(spark, sf, X.SPECIAL_USED).select("k", "nodes", X.characteristics(_P).alias("pairs"))
    return picked.select("k", *[X.special_field(_P, F.col("pairs"), n).alias(n) for n in _SPECIAL])


@register("metadata", "X29", f"""
    SELECT k, {_DESCRIPTION} AS description, {_SPECIAL['volume']} AS volume, {_SPECIAL['product_code']} AS product_code,
      [6, 2, 2, 5][l + 1] AS entry_count FROM {_FROM}""")
def metadata(spark, sf):
    picked = _parsed(spark, sf, X.SPECIAL_USED + X.DESCRIPTION_USED).select(
        "k", "nodes", X.characteristics(_P).alias("pairs"), X.description(_P).alias("description"))
    meta = picked.select("k", X.metadata(_P, F.col("pairs"), F.col("description")).alias("m"))
    return meta.select("k", F.col("m.__description").alias("description"), "m.volume", "m.product_code",
                       F.size("m.characteristics").alias("entry_count"))


_VOLUMES = "CASE l WHEN 0 THEN p_size || ' ml' WHEN 1 THEN p_size || ' ml|' || (p_size + 1) || ' ml' ELSE '' END"
_COLORS = "CASE l WHEN 0 THEN 'Red' WHEN 1 THEN 'цвет ' || p_brand WHEN 3 THEN 'Green|Blue' ELSE '' END"
_JSON_COUNT = "CASE WHEN l = 2 THEN 2 WHEN l = 3 THEN 1 ELSE 0 END"


@register("volume_variants", "X30", f"SELECT k, {_VOLUMES} AS variants FROM {_FROM}")
def volume_variants(spark, sf):
    return _take(spark, sf, X.VOLUMES_USED, variants=F.array_join(X.volume_variants(_P), "|"))


@register("color_variants", "X31", f"SELECT k, {_COLORS} AS variants FROM {_FROM}")
def color_variants(spark, sf):
    return _take(spark, sf, X.COLORS_USED, variants=F.array_join(X.color_variants(_P), "|"))


@register("json_variant_counts", "X32", f"SELECT k, {_JSON_COUNT} AS variant_count FROM {_FROM}")
def json_variant_counts(spark, sf):
    return _take(spark, sf, X.JSON_VARIANTS_USED, variant_count=X.json_variant_count(X.json_variants(_P)))


@register("distinct_variants", "X33", "SELECT p_partkey AS k, p_name || '|' || p_brand AS variants FROM part")
def distinct_variants(spark, sf):
    values = F.expr("array(p_name, upper(p_name), p_brand, concat(' ', p_name), p_brand)")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.array_join(X.distinct_variants(values), "|").alias("variants"))


@register("valid_variants", "X34", """
    SELECT p_partkey AS k, p_type NOT IN ('LARGE', 'SMALL', 'MEDIUM') AS of_type, p_partkey % 3 = 2 AS of_size,
      NOT regexp_matches(p_name, 'small|large|medium') AS of_name,
      false AS of_long FROM part""")
def valid_variants(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), X.is_variant(F.col("p_type")).alias("of_type"),
        X.is_variant(F.expr("element_at(array(' XL ', 'Выбрать', 'xlm'), CAST(p_partkey % 3 AS INT) + 1)")).alias("of_size"),
        X.is_variant(F.col("p_name")).alias("of_name"), X.is_variant(F.repeat("p_name", F.lit(20))).alias("of_long"))


@register("variant_counts", "X35", f"SELECT k, [2, 3, 2, 1][l + 1] AS variant_count FROM {_FROM}")
def variant_counts(spark, sf):
    picked = _take(spark, sf, X.JSON_VARIANTS_USED + X.VOLUMES_USED + X.COLORS_USED,
                   j=X.json_variants(_P), v=X.volume_variants(_P), c=X.color_variants(_P))
    return picked.select("k", X.variant_count(
        X.json_variant_count(F.col("j")), F.col("v"), F.col("c")).alias("variant_count"))


@register("ratings", "X36", f"""
    SELECT k, CASE WHEN l = 0 THEN p_size % 5 + 0.5::DOUBLE END AS rating, CASE WHEN l = 0 THEN p_size END AS review_count FROM {_FROM}""")
def ratings(spark, sf):
    return _take(spark, sf, X.RATING_USED, rating=X.rating(_P), review_count=X.review_count(_P))


_PRODUCT = f"""SELECT CASE WHEN l = 3 THEN 'p-' ELSE '' END || k AS product_id, p_name || coalesce(' ' || {_VOLUME}, '') AS name,
  CASE WHEN l < 2 THEN p_type ELSE 'meta ' || p_type END AS category, CAST(p_size AS VARCHAR) AS category_id, p_retailprice AS price,
  CASE WHEN l < 3 THEN round(p_retailprice + p_size, 2) ELSE p_retailprice END AS original_price,
  CASE WHEN l < 3 THEN trunc((round(p_retailprice + p_size, 2) - p_retailprice) / round(p_retailprice + p_size, 2) * 100)::INT ELSE 0 END
    AS discount_percentage, {_ROUTED['volume']} AS volume, CASE l WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size END::DOUBLE AS alcohol_content,
  CASE WHEN l < 3 THEN p_brand END AS brand, {_ROUTED['country']} AS country, CASE WHEN l = 0 THEN CAST(1990 + p_size AS VARCHAR) END AS year,
  {_DESCRIPTION} AS description, coalesce({_IN_STOCK}, true) AS in_stock, coalesce({_COUNT}, 0) AS stock_quantity, {_STATUS} AS availability_status,
  CASE WHEN l = 0 THEN p_size % 5 + 0.5::DOUBLE END AS rating, CASE WHEN l = 0 THEN p_size END AS review_count, {_MAIN} AS image_url,
  {_GALLERY} AS image_urls, CASE WHEN l < 3 THEN 'SKU-' || k END AS sku, 1700000000::BIGINT AS scraped_at, 'krasnodar' AS region,
  'shop.example' AS source, [2, 3, 2, 1][l + 1] AS variants_count FROM {_FROM}"""
_PRODUCT_COLUMNS = (
    "product_id name category category_id price discount_percentage volume alcohol_content brand country year description "
    "in_stock stock_quantity availability_status rating review_count image_url sku scraped_at region source").split()


def _rows(spark, sf):
    return X.product_rows(product_pages(spark, sf), scraped_at=1700000000, source="shop.example")


@register("product_rows", "X37", _PRODUCT)
def product_rows(spark, sf):
    return _rows(spark, sf).select(
        *_PRODUCT_COLUMNS, F.round("original_price", 2).alias("original_price"),
        F.array_join("image_urls", "|").alias("image_urls"), "variants_count")


@register("product_attributes", "X37 X29", f"""
    SELECT CASE WHEN l = 3 THEN 'p-' ELSE '' END || k AS product_id, [2, 3, 2, 1][l + 1] AS variants_count,
      {_SPECIAL['volume']} AS volume, {_DESCRIPTION} AS description, l < 3 AS has_tags FROM {_FROM}""")
def product_attributes(spark, sf):
    a = F.col("attributes")
    return _rows(spark, sf).select(
        "product_id", F.expr("try_variant_get(attributes['variants_count'], '$', 'int')").alias("variants_count"),
        a["volume"].cast("string").alias("volume"), a["__description"].cast("string").alias("description"),
        F.map_contains_key("attributes", "marketing_tags").alias("has_tags"))


@register("pages_to_clean_products", "X37 P20", f"""
    SELECT category, count(*) AS product_count, round(avg(price), 6) AS avg_price, count(rating) AS rated FROM ({_PRODUCT}) GROUP BY 1""")
def pages_to_clean_products(spark, sf):
    cleaned = clean_products(_rows(spark, sf), source="shop.example")
    return cleaned.groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"), F.round(F.avg("price"), 6).alias("avg_price"),
        F.count("rating").alias("rated"))


@register("real_page_products", "X37 H9", """
    SELECT page_id, regexp_extract(replace(replace(html, chr(10), ' '), '&amp;', '&'), '<h1>(.*?)</h1>', 1) AS heading FROM pages""")
def real_page_products(spark, sf):
    return X.product_pages(pages(spark, sf)).select("page_id", X.heading(_P).alias("heading"))

"""Queries over the cleaning chain, on dirty products derived from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.text import collapse
from vitrine.operators import clean
from vitrine.plans.registry import register
from vitrine.plans.shapes import dirty_products, documents, table

# The rows that pass validation, told from the clean columns.
_ACCEPTED = "p_partkey % 97 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 89 <> 0 AND p_partkey % 83 <> 0"
_AT = 1
_WHO = {"region": "krasnodar", "source": "shop.example"}


def _chain(spark, sf):
    return clean.clean_products(dirty_products(spark, sf), scraped_at=_AT, **_WHO)


@register("accepted_products", "P1", f"SELECT p_partkey AS k FROM part WHERE {_ACCEPTED}")
def accepted_products(spark, sf):
    return clean.validate(dirty_products(spark, sf)).select("k")


@register("rejected_products", "P1 F8", f"""
    SELECT p_partkey AS k, 'Validation failed: ' || concat_ws('; ',
      CASE WHEN p_partkey % 97 = 0 THEN 'Missing required field: product_id' END,
      CASE WHEN p_partkey % 11 = 0 THEN 'Missing required field: name' END,
      CASE WHEN p_partkey % 89 = 0 THEN 'Missing required field: product_url' END,
      CASE WHEN p_partkey % 83 = 0 THEN 'Missing required field: scraped_at' END) AS message
    FROM part WHERE NOT ({_ACCEPTED})""")
def rejected_products(spark, sf):
    return clean.rejected(dirty_products(spark, sf)).select("k", "message")


@register("nested_price_fix", "P2", f"""
    SELECT p_partkey AS k, CASE WHEN p_partkey % 8 <> 5 THEN
        CASE WHEN p_partkey % 6 = 0 AND p_partkey % 9 = 4 THEN p_retailprice * 2 ELSE p_retailprice END END AS current,
      CASE WHEN p_partkey % 8 <> 5 THEN CASE WHEN p_partkey % 9 = 4 THEN 0 ELSE p_retailprice END END AS original
    FROM part WHERE {_ACCEPTED}""")
def nested_price_fix(spark, sf):
    return clean.validate(dirty_products(spark, sf)).select("k", "price_data.current", "price_data.original")


@register("negative_stock_fix", "P3", f"""
    SELECT p_partkey AS k, CASE WHEN p_partkey % 10 <> 7 THEN
      CASE p_partkey % 9 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE p_size END END AS stock_count FROM part WHERE {_ACCEPTED}""")
def negative_stock_fix(spark, sf):
    return clean.validate(dirty_products(spark, sf)).select("k", F.col("stock_data.count").alias("stock_count"))


@register("flat_price_fix", "P4", f"""
    WITH d AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
          WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1 ELSE p_retailprice + p_size END AS original
      FROM part WHERE {_ACCEPTED})
    SELECT p_partkey AS k, CASE WHEN price > original THEN original ELSE price END AS price, original AS original_price FROM d""")
def flat_price_fix(spark, sf):
    return clean.validate(dirty_products(spark, sf)).select("k", "price", "original_price")


@register("line_price_fix", "P4", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - abs(l_discount)) AS price,
      l_extendedprice AS original_price, false AS was_above FROM lineitem""")
def line_price_fix(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "CAST(l_orderkey AS STRING) AS product_id", "'n' AS name", "'u' AS product_url", "1L AS scraped_at",
        "l_extendedprice * (1 - abs(l_discount)) AS price", "l_extendedprice AS original_price")
    return clean.validate(rows).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", "original_price",
        F.array_contains("corrections", "price_above_original").alias("was_above"))


@register("default_values", "P5", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 1 THEN 0 ELSE 6 END AS tag_count, p_partkey % 4 < 2 AS no_images,
      CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 0 END AS review_count, 0 AS stock_quantity,
      CASE WHEN p_partkey % 5 = 0 THEN 'USD' ELSE 'RUB' END AS currency,
      CASE WHEN p_partkey % 4 = 0 THEN 'msk' ELSE 'krasnodar' END AS region, 'shop.example' AS source,
      '' AS scraper_notes, true AS is_valid, 0 AS error_count FROM part""")
def default_values(spark, sf):
    return clean.defaults(dirty_products(spark, sf), scraped_at=_AT, **_WHO).select(
        "k", F.size("marketing_tags").alias("tag_count"), (F.size("image_urls") == 0).alias("no_images"),
        "review_count", "stock_quantity", "currency", "region", "source", "scraper_notes", "is_valid",
        F.size("validation_errors").alias("error_count"))


@register("default_time", "P6", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 1700000000 ELSE 5 + p_partkey END::BIGINT AS scraped_at FROM part""")
def default_time(spark, sf):
    rows = dirty_products(spark, sf).select("k", F.expr("CASE WHEN k % 2 = 1 THEN 5 + k END").alias("scraped_at"))
    return clean.defaults(rows, scraped_at=1700000000).select("k", "scraped_at")


@register("default_price_data", "P7", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'RUB' END AS currency,
      CAST(NULL AS VARCHAR) AS sale_tag FROM part WHERE p_partkey % 8 <> 5""")
def default_price_data(spark, sf):
    rows = dirty_products(spark, sf).withColumn("price_data", F.col("price_data").dropFields("sale_tag"))
    return clean.defaults(rows, scraped_at=_AT).where("price_data IS NOT NULL").select(
        "k", "price_data.currency", "price_data.sale_tag")


@register("default_assets", "P8", """
    SELECT p_partkey AS k, '/m/' || p_partkey AS main_image, 3 AS gallery, 0 AS views, 2 AS videos, 0 AS cached
    FROM part WHERE p_partkey % 5 <> 2""")
def default_assets(spark, sf):
    return clean.defaults(dirty_products(spark, sf), scraped_at=_AT).where("assets IS NOT NULL").select(
        "k", "assets.main_image", F.size("assets.gallery_images").alias("gallery"), F.size("assets.view_360").alias("views"),
        F.size("assets.video").alias("videos"), F.size("assets.cached_images").alias("cached"))


@register("default_stock", "P9", """
    SELECT p_partkey AS k, p_partkey % 3 = 0 AS in_stock,
      CASE p_partkey % 9 WHEN 0 THEN -p_size WHEN 1 THEN 0 ELSE p_size END AS stock_count,
      CASE WHEN p_partkey % 4 = 0 THEN 'В наличии' ELSE 'unknown' END AS status, 0 AS regions
    FROM part WHERE p_partkey % 10 <> 7""")
def default_stock(spark, sf):
    return clean.defaults(dirty_products(spark, sf), scraped_at=_AT).where("stock_data IS NOT NULL").select(
        "k", "stock_data.in_stock", F.col("stock_data.count").alias("stock_count"), "stock_data.status",
        F.size("stock_data.available_regions").alias("regions"))


@register("clean_text_fields", "P10", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS name, p_type AS category,
      CASE WHEN p_partkey % 7 <> 3 THEN p_brand END AS brand, p_name || ' ' || p_type || ' ' || p_brand AS description
    FROM part""")
def clean_text_fields(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", "name", "category", "brand", "description")


@register("clean_marketing_tags", "P11", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 6 <> 1 THEN
      array_to_string(list_sort(['Apple', p_brand, p_type]), '|') END AS tags FROM part""")
def clean_marketing_tags(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", F.array_join("marketing_tags", "|").alias("tags"))


@register("clean_attributes", "P12", """
    SELECT p_partkey AS k, p_size || ' ml' AS volume, p_brand AS brand, 2 AS entry_count FROM part""")
def clean_attributes(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select(
        "k", F.col("attributes")["volume"].alias("volume"), F.col("attributes")["brand"].alias("brand"),
        F.size("attributes").alias("entry_count"))


@register("clean_mixed_attributes", "P12", """
    SELECT p_partkey AS k, '{"list":[' || CASE WHEN p_partkey = 0 THEN '' ELSE p_partkey || ',' END || '"x"],"num":' || p_size || ',"text":"' || p_name || ' x"}' AS attributes
    FROM part""")
def clean_mixed_attributes(spark, sf):
    rows = dirty_products(spark, sf).join(_names(spark, sf), "k").select("k", F.expr("""
      try_variant_get(parse_json(concat('{"text":"  ', clean_name, '   x","list":[', k, ',"",null,0,"x",false],"num":', size,
        ',"none":null,"":1}')), '$', 'map<string,variant>')""").alias("attributes"))
    return clean.clean(rows).select("k", F.to_json(F.to_variant_object(F.col("attributes"))).alias("attributes"))


def _names(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey AS k", "p_name AS clean_name", "p_size AS size")


@register("clean_image_urls", "P13", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 4 > 1 THEN
      '/b/' || p_partkey || ',/a/' || p_partkey END AS urls FROM part""")
def clean_image_urls(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", F.array_join("image_urls", ",").alias("urls"))


@register("clean_tags", "P14", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 6 <> 2 THEN p_type || '|apple|zebra' END AS tags FROM part""")
def clean_tags(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", F.array_join("tags", "|").alias("tags"))


@register("clean_assets", "P15", """
    SELECT p_partkey AS k, '/g/' || p_size || ',/g/0' AS gallery, '/v' AS video, CAST(NULL AS VARCHAR) AS views
    FROM part WHERE p_partkey % 5 <> 2""")
def clean_assets(spark, sf):
    return clean.clean(dirty_products(spark, sf)).where("assets IS NOT NULL").select(
        "k", F.array_join("assets.gallery_images", ",").alias("gallery"),
        F.array_join("assets.video", ",").alias("video"), F.array_join("assets.view_360", ",").alias("views"))


@register("clean_descriptions", "P16", r"""
    SELECT doc_id, trim(regexp_replace(replace(text, chr(13), ''), '[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f]+', ' ', 'g')) AS description,
      false AS has_breaks FROM documents""")
def clean_descriptions(spark, sf):
    one_line = clean.clean_description(F.col("text"))
    return documents(spark, sf).select(
        "doc_id", one_line.alias("description"), one_line.rlike("[\\r\\n]").alias("has_breaks"))


@register("clean_prices", "P17", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 13 = 0 THEN 0 WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
        WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
      CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN 0 ELSE p_retailprice + p_size END AS original_price,
      CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS from_text
    FROM part""")
def clean_prices(spark, sf):
    as_text = dirty_products(spark, sf).join(_prices(spark, sf), "k")
    texts = clean.clean(as_text.select("k", F.col("price_text").alias("price"))).select(
        "k", F.col("price").alias("from_text"))
    return clean.clean(dirty_products(spark, sf)).select("k", "price", "original_price").join(texts, "k")


def _prices(spark, sf):
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS k", "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_retailprice AS STRING) ELSE 'n/a' END AS price_text")


@register("clean_rating", "P18", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 23 <> 0 AND p_partkey % 80 <= 50 THEN (p_partkey % 80) / 10 END AS rating
    FROM part""")
def clean_rating(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", "rating")


@register("clean_discount", "P19", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 130 - 10 BETWEEN 0 AND 100 THEN CAST(p_partkey % 130 - 10 AS INT) ELSE 0 END
      AS discount_percentage FROM part""")
def clean_discount(spark, sf):
    return clean.clean(dirty_products(spark, sf)).select("k", "discount_percentage")


@register("cleaned_products", "P20 P1 P2 P3 P4 P5 P7 P8 P9 P10 P11 P13 P15 P17 P18 P19", f"""
    WITH d AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
          WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1 ELSE p_retailprice + p_size END AS original
      FROM part WHERE {_ACCEPTED})
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
      CASE WHEN price > original THEN greatest(original, 0) WHEN price < 0 THEN 0 ELSE price END AS price,
      CASE WHEN original < 0 THEN 0 ELSE original END AS original_price,
      CASE WHEN p_partkey % 8 <> 5 THEN CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'RUB' END END AS price_currency,
      CASE WHEN p_partkey % 10 <> 7 THEN CASE WHEN p_partkey % 9 IN (0, 1) THEN 0 ELSE p_size END END AS stock_count,
      CASE WHEN p_partkey % 23 <> 0 AND p_partkey % 80 <= 50 THEN (p_partkey % 80) / 10 END AS rating,
      CASE WHEN p_partkey % 6 <> 1 THEN array_to_string(list_sort(['Apple', p_brand, p_type]), '|') ELSE '' END AS marketing_tags,
      CASE WHEN p_partkey % 5 <> 2 THEN '/g/' || p_size || ',/g/0' END AS gallery,
      CASE WHEN p_partkey % 4 = 0 THEN 'msk' ELSE 'krasnodar' END AS region FROM d""")
def cleaned_products(spark, sf):
    return _chain(spark, sf).select(
        "product_id", "name", "category", "price", "original_price",
        F.col("price_data.currency").alias("price_currency"), F.col("stock_data.count").alias("stock_count"), "rating",
        F.array_join("marketing_tags", "|").alias("marketing_tags"),
        F.array_join("assets.gallery_images", ",").alias("gallery"), "region")


@register("correction_summary", "P21", f"""
    WITH d AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
          WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1 ELSE p_retailprice + p_size END AS original
      FROM part WHERE {_ACCEPTED})
    SELECT 'price_data_above_original' AS correction, count(*) FILTER (p_partkey % 8 <> 5 AND p_partkey % 6 = 0 AND p_partkey % 9 <> 4) AS row_count FROM d
    UNION ALL SELECT 'stock_count_negative', count(*) FILTER (p_partkey % 10 <> 7 AND p_partkey % 9 = 0) FROM d
    UNION ALL SELECT 'price_above_original', count(*) FILTER (price > original) FROM d
    UNION ALL SELECT 'price_negative', count(*) FILTER (CASE WHEN price > original THEN original ELSE price END < 0) FROM d
    UNION ALL SELECT 'original_price_negative', count(*) FILTER (original < 0) FROM d
    UNION ALL SELECT 'rating_out_of_range', count(*) FILTER (p_partkey % 23 <> 0 AND p_partkey % 80 > 50) FROM d
    UNION ALL SELECT 'discount_out_of_range', count(*) FILTER (p_partkey % 130 - 10 NOT BETWEEN 0 AND 100) FROM d""")
def correction_summary(spark, sf):
    return clean.correction_summary(_chain(spark, sf))


@register("category_prices_cleaned", "A3 P20", f"""
    WITH d AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
          WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
        CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1 ELSE p_retailprice + p_size END AS original
      FROM part WHERE {_ACCEPTED})
    SELECT p_type AS category, count(*) AS product_count, round(avg(
      CASE WHEN price > original THEN greatest(original, 0) WHEN price < 0 THEN 0 ELSE price END), 6) AS avg_price
    FROM d GROUP BY 1""")
def category_prices_cleaned(spark, sf):
    return _chain(spark, sf).groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"), F.round(F.avg("price"), 6).alias("avg_price"))


@register("collapsed_documents", "F10", r"""
    SELECT lang, count(*) AS doc_count, sum(length(trim(regexp_replace(text, '[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f]+', ' ', 'g'))))::BIGINT AS chars
    FROM documents GROUP BY lang""")
def collapsed_documents(spark, sf):
    return documents(spark, sf).groupBy("lang").agg(
        F.count(F.lit(1)).alias("doc_count"), F.sum(F.length(collapse(F.col("text")))).alias("chars"))

"""Queries over the scalar functions and the entity loaders."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions import text
from vitrine.functions.nodes import Sel, all_attrs, all_texts, parse_nodes, select
from vitrine.operators.conform import conform
from vitrine.plans.registry import register
from vitrine.plans.shapes import crawl_log, documents, pages, product_pages, table
from vitrine.schemas import ASSETS, CATEGORY, ERROR, PRICE_DATA, PRICE_HISTORY, PRODUCT, REVIEW, STOCK, STORE


@register("parse_price", "F1", """
    SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE p_retailprice END AS price FROM part""")
def parse_price(spark, sf):
    raw = F.expr("""CASE p_partkey % 5 WHEN 0 THEN concat('Цена: ', replace(p_retailprice, '.', ','), ' РУБ')
      WHEN 1 THEN concat('\\u00A0$', p_retailprice, '\\t') WHEN 2 THEN concat(p_retailprice, ' ₽')
      WHEN 3 THEN 'abc' ELSE concat('1.', p_retailprice) END""")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), text.parse_price(raw).alias("price"))


@register("discount", "F2", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_quantity = 1 THEN NULL ELSE CAST(trunc(greatest(0, least(100,
        (l_extendedprice - l_extendedprice * (1 - l_discount)) / l_extendedprice * 100))) AS INT) END AS percent
    FROM lineitem""")
def discount(spark, sf):
    now = F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        text.calculate_discount(F.col("l_extendedprice"), now).alias("percent"))


@register("clean_title", "F3 F10", r"""
    SELECT doc_id, coalesce(trim(regexp_replace(text, '[\s\x{00A0}\x{0085}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f]+', ' ', 'g')), '') AS title
    FROM documents""")
def clean_title(spark, sf):
    return documents(spark, sf).select("doc_id", text.clean_title(F.col("text")).alias("title"))


@register("strip_text", "F10", """
    SELECT p_partkey AS k, p_name AS stripped FROM part""")
def strip_text(spark, sf):
    raw = F.expr("concat('\\u00A0\\t ', p_name, ' \\n\\u2003')")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), text.strip(raw).alias("stripped"))


@register("extract_number", "F4", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS number FROM part""")
def extract_number(spark, sf):
    raw = F.expr("CASE WHEN p_partkey % 6 = 0 THEN p_name ELSE concat(p_name, ' -', p_size, 'ml 77') END")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), text.extract_number(raw).alias("number"))


@register("extract_float", "F5", """
    SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN CAST(p_size AS DOUBLE) END AS number
    FROM part""")
def extract_float(spark, sf):
    raw = F.expr("""CASE p_partkey % 3 WHEN 0 THEN concat('Rating: -', p_retailprice, ' stars 3')
      WHEN 1 THEN concat(p_size, ',5') END""")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), text.extract_float(raw).alias("number"))


@register("valid_email", "F6", """
    SELECT c_custkey AS k, c_custkey % 4 = 0 AS is_valid FROM customer""")
def valid_email(spark, sf):
    raw = F.expr("""CASE c_custkey % 4 WHEN 0 THEN concat('user.', c_custkey, '+x@mail.example.com')
      WHEN 1 THEN concat('user', c_custkey, '@mail') WHEN 2 THEN concat('@', c_custkey, '.com') END""")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), text.is_valid_email(raw).alias("is_valid"))


@register("normalize_bool", "F7", """
    SELECT event_id, event_type IN ('click', 'view') AS from_text, value <> 0 AS from_number,
      event_type = 'error' AS from_bool FROM events""")
def normalize_bool(spark, sf):
    raw = F.expr("CASE event_type WHEN 'click' THEN ' In Stock\\t' WHEN 'view' THEN 'YES' WHEN 'error' THEN 'no' END")
    flag = F.col("event_type") == "error"
    e = table(spark, sf, "events")
    return e.select(
        "event_id", text.normalize_bool(raw).alias("from_text"),
        text.normalize_bool(F.col("value"), e.schema["value"].dataType).alias("from_number"),
        text.normalize_bool(flag, _BOOL).alias("from_bool"))


_BOOL = STOCK.schema["in_stock"].dataType


@register("required_field", "F8", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 5 < 2 THEN 'Required field ''name'' is missing' END AS problem,
      p_brand AS brand FROM part""")
def required_field(spark, sf):
    raw = F.expr("CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' \\t\\u00A0' ELSE p_name END")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), text.required_error(raw, "name").alias("problem"),
        text.require(F.col("p_brand"), "brand").alias("brand"))


@register("normalize_url", "F9", """
    SELECT page_id, url AS kept, 'https://cdn.example/i.png' AS schemeless,
      regexp_extract(url, '^https?://[^/?#]*') || '/a/b.png' AS rooted, CAST(NULL AS VARCHAR) AS missing FROM pages""")
def normalize_url(spark, sf):
    base = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", text.normalize_url(base, F.concat(F.lit(" "), base, F.lit("\n"))).alias("kept"),
        text.normalize_url(base, F.lit("//cdn.example/i.png")).alias("schemeless"),
        text.normalize_url(base, F.lit("/a/./c/../b.png")).alias("rooted"),
        text.normalize_url(base, F.lit("")).alias("missing"))


@register("resolve_url", "H5", r"""
    WITH u AS (SELECT page_id, url, regexp_extract(url, '^(https?)://', 1) AS scheme,
                 regexp_extract(url, '^https?://[^/?#]*') AS origin, regexp_extract(url, '^[^?#]*') AS plain FROM pages)
    SELECT page_id, regexp_replace(plain, '[^/]*$', '') || 'x/y' AS sibling, plain || '?q=1' AS query,
      regexp_replace(url, '#.*$', '') || '#f' AS fragment, scheme || '://h.example/z' AS schemeless,
      origin || '/z' AS above, url AS itself, 'mailto:a@b.example' AS other FROM u""")
def resolve_url(spark, sf):
    base = F.col("url")
    hrefs = {"sibling": "x/y", "query": "?q=1", "fragment": "#f", "schemeless": "//h.example/z",
             "above": "../../../z", "itself": "", "other": "mailto:a@b.example"}
    return table(spark, sf, "pages").select(
        "page_id", *[text.resolve_url(base, F.lit(h)).alias(n) for n, h in hrefs.items()])


@register("valid_url", "F11", """
    SELECT page_id, true AS whole, false AS no_host, false AS no_scheme, page_id % 2 = 0 AS mixed FROM pages""")
def valid_url(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", text.is_url(u).alias("whole"),
        text.is_url(F.regexp_replace(u, "//.*$", "///x")).alias("no_host"),
        text.is_url(F.regexp_replace(u, "^https?:", "")).alias("no_scheme"),
        text.is_url(F.when(F.col("page_id") % 2 == 0, F.concat(u, F.lit(" with blank")))).alias("mixed"))


@register("loader_values", "F12", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS first_text,
      CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_retailprice END AS as_float,
      CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS as_int,
      p_partkey % 2 = 1 AS as_bool, p_partkey % 3 <> 0 AS has_text FROM part""")
def loader_values(spark, sf):
    lists = table(spark, sf, "part").selectExpr(
        "p_partkey AS k",
        "CASE WHEN p_partkey % 4 = 0 THEN CAST(array() AS ARRAY<STRING>) ELSE array(p_name, 'x') END AS names",
        "CASE WHEN p_partkey % 4 = 0 THEN array('abc', '1') ELSE array(CAST(p_retailprice AS STRING)) END AS prices",
        "CASE WHEN p_partkey % 4 = 0 THEN array('1.5') ELSE array(concat(' ', p_size)) END AS sizes",
        "CASE WHEN p_partkey % 2 = 1 THEN array('on', 'no') ELSE CAST(array() AS ARRAY<STRING>) END AS flags",
        "CASE WHEN p_partkey % 3 <> 0 THEN array(NULL, '', p_name) ELSE array('', NULL) END AS texts")
    return lists.select(
        "k", text.first_value(F.col("names")).alias("first_text"), text.float_value(F.col("prices")).alias("as_float"),
        text.int_value(F.col("sizes")).alias("as_int"), text.bool_value(F.col("flags")).alias("as_bool"),
        text.take_first(F.col("texts")).isNotNull().alias("has_text"))


@register("load_product", "F13", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_brand AS brand, p_type AS category,
      p_retailprice AS price, p_retailprice + p_size AS original_price, p_size AS stock_quantity,
      p_partkey % 2 = 0 AS in_stock, CASE WHEN p_partkey % 3 = 0 THEN 'RUB' ELSE 'USD' END AS currency,
      CAST(p_size AS DOUBLE) AS alcohol_content, CAST(1990 + p_size AS VARCHAR) AS year, p_size AS review_count,
      CAST(p_size AS DOUBLE) / 10 AS rating, p_type || ',' || p_brand AS tags, CAST(1700000000 + p_partkey AS BIGINT) AS scraped_at,
      CAST(NULL AS VARCHAR) AS barcode FROM part""")
def load_product(spark, sf):
    raw = table(spark, sf, "part").selectExpr(
        "concat(' ', p_partkey, ' ') AS product_id", "array('', replace(p_name, ' ', '  '), 'x') AS name",
        "concat(p_brand, '\\n') AS brand", "array(' ', p_type) AS category",
        "array('n/a', concat(p_retailprice, ' ₽')) AS price", "CAST(p_retailprice + p_size AS STRING) AS original_price",
        "concat(p_size, ' шт') AS stock_quantity", "CASE WHEN p_partkey % 2 = 0 THEN 'available' ELSE 'sold' END AS in_stock",
        "CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE ' USD' END AS currency", "concat(p_size, '%') AS alcohol_content",
        "concat('г. ', 1990 + p_size) AS year", "array('none', concat(p_size, ' reviews')) AS review_count",
        "concat(p_size / 10, ' of 5') AS rating", "array(p_type, p_brand) AS tags", "1700000000L + p_partkey AS scraped_at")
    shown = ("product_id name brand category price original_price stock_quantity in_stock currency alcohol_content "
             "year review_count rating scraped_at barcode").split()
    return conform(raw, PRODUCT).select(*shown, F.array_join("tags", ",").alias("tags"))


@register("load_price_data", "F14", """
    SELECT p_retailprice AS current, CAST(NULL AS DOUBLE) AS original, 'sale' AS sale_tag, 'RUB' AS currency FROM part""")
def load_price_data(spark, sf):
    return conform(table(spark, sf, "part").selectExpr(
        "concat(p_retailprice, ' ₽') AS current", "'free' AS original", "' sale ' AS sale_tag", "'' AS currency"), PRICE_DATA)


@register("load_stock", "F14", """
    SELECT p_partkey % 2 = 0 AS in_stock, p_size AS count, p_brand AS status, p_type AS available_regions FROM part""")
def load_stock(spark, sf):
    return conform(table(spark, sf, "part").selectExpr(
        "CASE WHEN p_partkey % 2 = 0 THEN array('yes') ELSE CAST(array() AS ARRAY<STRING>) END AS in_stock",
        "concat('x', p_size) AS count", "concat(' ', p_brand) AS status", "array(p_type) AS available_regions"),
        STOCK).withColumn("available_regions", F.array_join("available_regions", ","))


@register("load_assets", "F14", """
    SELECT '/m/' || p_partkey AS main_image, '/a,/b' AS gallery_images, CAST(NULL AS VARCHAR) AS view_360,
      '/v/' || p_partkey || ',/w' AS video, CAST(NULL AS VARCHAR) AS cached_images FROM part""")
def load_assets(spark, sf):
    rows = conform(table(spark, sf, "part").selectExpr(
        "concat(' /m/', p_partkey) AS main_image", "array('/a', '/b') AS gallery_images",
        "array(concat('/v/', p_partkey, ' '), NULL, ' /w') AS video"), ASSETS)
    return rows.select("main_image", *[
        F.array_join(c, ",").alias(c) for c in ("gallery_images", "view_360", "video", "cached_images")])


@register("load_category", "F14", """
    SELECT CAST(n_nationkey AS VARCHAR) AS category_id, n_name AS name, CAST(NULL AS VARCHAR) AS description,
      '/c/' || n_name AS url, n_nationkey AS product_count, CAST(n_regionkey AS VARCHAR) AS parent_category,
      CAST(NULL AS VARCHAR) AS image_url, CAST(NULL AS BIGINT) AS scraped_at FROM nation""")
def load_category(spark, sf):
    return conform(table(spark, sf, "nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS category_id", "concat(n_name, '\\t') AS name", "concat(' /c/', n_name) AS url",
        "concat('(', n_nationkey, ')') AS product_count", "CAST(n_regionkey AS STRING) AS parent_category"), CATEGORY)


@register("load_store", "F14", """
    SELECT CAST(c_custkey AS VARCHAR) AS store_id, c_name AS name, c_mktsegment AS address, CAST(NULL AS VARCHAR) AS city,
      CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS website, abs(c_acctbal) AS latitude,
      CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS BIGINT) AS scraped_at FROM customer""")
def load_store(spark, sf):
    return conform(table(spark, sf, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS store_id", "concat(' ', c_name) AS name", "concat(c_mktsegment, ' ') AS address",
        "concat('lat ', CAST(c_acctbal AS DECIMAL(18,2))) AS latitude", "'unknown' AS longitude"), STORE)


@register("load_price_history", "F14", """
    SELECT CAST(o_custkey AS VARCHAR) AS product_id, o_totalprice AS price, CAST(o_orderkey % 100 AS INT) AS discount_percentage,
      o_orderstatus = 'O' AS in_stock, o_orderpriority AS region, strftime(o_orderdate, '%Y-%m-%d') AS timestamp,
      CAST(NULL AS VARCHAR) AS store_id FROM orders""")
def load_price_history(spark, sf):
    return conform(table(spark, sf, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS product_id", "concat(CAST(o_totalprice AS DECIMAL(18,2)), ' руб') AS price",
        "concat('-', o_orderkey % 100, '%') AS discount_percentage",
        "CASE WHEN o_orderstatus = 'O' THEN 'in stock' ELSE 'gone' END AS in_stock", "o_orderpriority AS region",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS timestamp"), PRICE_HISTORY)


@register("load_review", "F14", """
    SELECT CAST(l_orderkey AS VARCHAR) AS review_id, CAST(l_partkey AS VARCHAR) AS product_id, l_linenumber AS rating,
      l_returnflag AS text, l_linestatus AS reviewer_name, CAST(NULL AS VARCHAR) AS date,
      CAST(l_quantity AS INT) AS helpful_count, l_returnflag = 'R' AS verified_purchase, CAST(NULL AS BIGINT) AS scraped_at
    FROM lineitem""")
def load_review(spark, sf):
    return conform(table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS review_id", "CAST(l_partkey AS STRING) AS product_id",
        "concat(l_linenumber, ' stars of 7') AS rating", "concat(l_returnflag, '\\n') AS text",
        "concat(' ', l_linestatus) AS reviewer_name", "concat(CAST(l_quantity AS INT), ' found this helpful') AS helpful_count",
        "l_returnflag = 'R' AS verified_purchase"), REVIEW)


@register("load_error", "F14", """
    SELECT CAST(event_id AS VARCHAR) AS error_id, event_type AS error_type, props AS message, CAST(NULL AS VARCHAR) AS url,
      CAST(NULL AS VARCHAR) AS spider_name, CAST(NULL AS VARCHAR) AS traceback, CAST(NULL AS VARCHAR) AS timestamp,
      CASE WHEN event_id % 2 = 0 THEN 'INFO' ELSE 'ERROR' END AS severity FROM events""")
def load_error(spark, sf):
    return conform(table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS error_id", "event_type AS error_type", "concat(props, ' ') AS message",
        "CASE WHEN event_id % 2 = 0 THEN '' ELSE 'ERROR' END AS severity"), ERROR)


@register("error_classes", "F15", """
    WITH e AS (SELECT event_id, user_id, value, CAST(json_extract_string(props, '$.k') AS INT) AS n FROM events)
    SELECT event_id, CASE n % 5 WHEN 0 THEN 'dns' WHEN 1 THEN 'timeout' WHEN 2 THEN 'refused'
        WHEN 3 THEN 'http_' || (400 + n) ELSE 'other' END AS error_class,
      CASE n % 5 WHEN 0 THEN 'DNS Lookup Error on ' WHEN 1 THEN 'Timeout Error on ' WHEN 2 THEN 'Connection Refused on '
        WHEN 3 THEN 'HTTP Error ' || (400 + n) || ' on ' ELSE 'Error ValueError on ' END
        || 'https://shop.example/' || event_id || CASE WHEN n % 5 = 4 THEN ': m' ELSE '' END AS line FROM e""")
def error_classes(spark, sf):
    url = F.concat(F.lit("https://shop.example/"), F.col("event_id").cast("string"))
    return crawl_log(spark, sf).select(
        "event_id", text.error_class(F.col("error_type"), F.col("status")).alias("error_class"),
        text.error_message(F.col("error_type"), F.col("status"), url, F.lit("m")).alias("line"))

"""Queries over the quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import quality
from vitrine.plans.registry import register
from vitrine.plans.shapes import dirty_products, product_json, table


@register("required_completeness", "Q1", """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (p_partkey % 97 <> 0) AS a, count(*) FILTER (p_partkey % 11 <> 0) AS b,
        count(*) FILTER (p_partkey % 89 <> 0) AS c, count(*) FILTER (p_partkey % 83 <> 0) AS d FROM part),
      r AS (SELECT 'product_id' AS field, a AS filled, n AS total FROM c UNION ALL SELECT 'name', b, n FROM c
        UNION ALL SELECT 'product_url', c, n FROM c UNION ALL SELECT 'scraped_at', d, n FROM c UNION ALL SELECT 'absent', 0, n FROM c)
    SELECT field, filled, total, filled = total AS found,
      CASE WHEN filled < total THEN 'Field ''' || field || ''' missing in ' || (total - filled) || ' items' END AS message FROM r""")
def required_completeness(spark, sf):
    return quality.completeness(dirty_products(spark, sf), (*quality.REQUIRED, "absent"))


@register("row_validity", "Q2", """
    SELECT count(*) AS total, count(*) FILTER (p_partkey % 97 <> 0 AND p_partkey % 11 <> 0) AS valid,
      count(*) FILTER (p_partkey % 97 = 0 OR p_partkey % 11 = 0) AS invalid,
      count(*) FILTER (p_partkey % 97 = 0) + count(*) FILTER (p_partkey % 11 = 0) + count(*) FILTER (p_partkey % 89 = 0)
        + count(*) FILTER (p_partkey % 83 = 0) AS errors FROM part""")
def row_validity(spark, sf):
    return quality.validity(dirty_products(spark, sf), required=quality.REQUIRED)


@register("field_statistics", "Q3 Q4", """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (p_partkey % 97 <> 0) AS pid, count(*) FILTER (p_partkey % 7 <> 3) AS brand,
        count(*) FILTER (p_partkey % 10 <> 7) AS stock, count(*) FILTER (p_partkey % 23 <> 0) AS rated,
        count(*) FILTER (p_partkey % 23 <> 0 AND p_partkey % 80 <> 0) AS rating,
        count(*) FILTER (p_partkey % 4 > 1) AS images, count(*) FILTER (p_partkey % 4 <> 1) AS image_lists,
        count(*) FILTER (p_partkey % 130 <> 10) AS discount FROM part),
      r AS (SELECT 'product_id' AS field, pid AS filled, n AS non_null, n AS total, 'string' AS type FROM c
        UNION ALL SELECT 'brand', brand, brand, n, 'string' FROM c UNION ALL SELECT 'stock_data', stock, stock, n, 'object' FROM c
        UNION ALL SELECT 'rating', rating, rated, n, 'float' FROM c UNION ALL SELECT 'image_urls', images, image_lists, n, 'array' FROM c
        UNION ALL SELECT 'attributes', n, n, n, 'object' FROM c UNION ALL SELECT 'discount_percentage', discount, n, n, 'integer' FROM c
        UNION ALL SELECT 'is_hit', 0, n, n, 'boolean' FROM c UNION ALL SELECT 'barcode', 0, 0, n, 'null' FROM c)
    SELECT field, filled, non_null, total, filled / total * 100 AS percentage, type FROM r""")
def field_statistics(spark, sf):
    return quality.field_stats(dirty_products(spark, sf).select(
        "product_id", "brand", "stock_data", "rating", "image_urls", "attributes", "discount_percentage",
        F.lit(False).alias("is_hit"), F.lit(None).cast("string").alias("barcode")))


@register("json_field_statistics", "Q3 Q4", """
    WITH c AS (SELECT p_partkey AS k, count(*) OVER () AS n FROM part),
      r AS (SELECT n, 'product_id' AS field, 'string' AS type, k % 7 <> 0 AS has, k % 7 <> 0 AS full_ FROM c
        UNION ALL SELECT n, 'name', 'string', true, k % 11 <> 0 FROM c
        UNION ALL SELECT n, 'product_url', 'string', k % 3 < 2, k % 3 < 2 FROM c
        UNION ALL SELECT n, 'scraped_at', 'string', true, true FROM c
        UNION ALL SELECT n, 'price', 'float', true, true FROM c
        UNION ALL SELECT n, 'original_price', 'integer', k % 4 = 0, k % 4 = 0 FROM c
        UNION ALL SELECT n, 'rating', 'integer', true, true FROM c
        UNION ALL SELECT n, 'review_count', 'float', true, k % 8 = 0 FROM c
        UNION ALL SELECT n, 'in_stock', 'boolean', true, k % 2 = 0 FROM c
        UNION ALL SELECT n, 'marketing_tags', 'string', true, true FROM c
        UNION ALL SELECT n, 'image_urls', 'object', true, k % 10 = 0 FROM c
        UNION ALL SELECT n, 'image_url', 'string', k % 12 = 0, k % 12 = 0 FROM c)
    SELECT field, count(*) FILTER (full_) AS filled, count(*) FILTER (has) AS non_null, n AS total,
      count(*) FILTER (full_) / n * 100 AS percentage, type FROM r GROUP BY field, n, type""")
def json_field_statistics(spark, sf):
    return quality.json_field_stats(product_json(spark, sf), F.col("k"))


@register("recommendations", "Q5", """
    WITH c AS (SELECT count(*) AS n, count(*) FILTER (p_partkey % 97 = 0 OR p_partkey % 11 = 0) AS bad,
      count(*) FILTER (p_partkey % 4 > 1 AND p_partkey % 4 < 3) AS few FROM part)
    SELECT 'High number of invalid items (' || format('{:.1f}', bad / n * 100) ||
      '%). Check spider selectors and data extraction logic.' AS recommendation FROM c WHERE bad / n > 0.1
    UNION ALL SELECT 'Field ''is_hit'' has only 0.0% filled. Consider updating selectors or adding fallback extraction methods.'
    UNION ALL SELECT 'Field ''rare'' has only ' || format('{:.1f}', few / n * 100) ||
      '% filled. Consider updating selectors or adding fallback extraction methods.' FROM c
    UNION ALL SELECT '✅ All validations passed! Data looks good.' FROM c WHERE bad < 0""")
def recommendations(spark, sf):
    d = dirty_products(spark, sf)
    stats = quality.field_stats(d.select(
        "product_url", F.lit(False).alias("is_hit"), F.when(F.col("k") % 4 == 2, F.col("k") + 1).alias("rare")))
    return quality.recommendations(quality.validity(d, required=quality.REQUIRED), stats)


@register("recommendations_clean", "Q5", """SELECT '✅ All validations passed! Data looks good.' AS recommendation""")
def recommendations_clean(spark, sf):
    d = dirty_products(spark, sf).select("k", F.lit("x").alias("product_id"), F.lit("y").alias("name"))
    return quality.recommendations(quality.validity(d, required=("product_id",)), quality.field_stats(d.select("name")))


def _checked(spark, sf):
    return quality.check_output(product_json(spark, sf), F.col("k"))


_ERRORS = """concat_ws('|', CASE WHEN p_partkey % 7 = 0 THEN 'Product ' || p_partkey || ': Missing required field ''product_id''' END,
    CASE WHEN p_partkey % 11 = 0 THEN 'Product ' || p_partkey || ': Missing required field ''name''' END,
    CASE WHEN p_partkey % 3 = 2 THEN 'Product ' || p_partkey || ': Missing required field ''product_url''' END)"""


@register("missing_field_errors", "Q6", f"SELECT p_partkey AS k, {_ERRORS} AS errors FROM part")
def missing_field_errors(spark, sf):
    return _checked(spark, sf).select("k", F.array_join("errors", "|").alias("errors"))


@register("output_warnings", "Q7 Q8 Q9 Q10 Q11", """
    WITH p AS (SELECT *, 'Product ' || p_partkey || ': ' AS who, CASE p_partkey % 5 WHEN 0 THEN -4.5::DOUBLE
        WHEN 1 THEN p_size::DOUBLE ELSE p_size + 0.5::DOUBLE END AS price FROM part)
    SELECT p_partkey AS k, concat_ws('|',
      CASE WHEN p_partkey % 5 = 1 THEN who || 'Field ''price'' has type str, expected float or int' END,
      CASE WHEN p_partkey % 5 = 0 THEN who || 'Field ''price'' is negative: -4.5' END,
      CASE WHEN p_partkey % 8 = 0 THEN who || 'Field ''review_count'' has type float, expected int' END,
      CASE WHEN p_partkey % 13 = 0 THEN who || 'Field ''scraped_at'' has type str, expected int' END,
      CASE WHEN p_partkey % 3 = 1 THEN who || 'Field ''product_url'' has invalid URL: shop.example/x' END,
      CASE WHEN p_partkey % 12 = 0 THEN who || 'Field ''image_url'' has invalid URL: /rel' END,
      CASE WHEN p_partkey % 4 = 0 AND price > 2 THEN who || 'Price (' || price || ') > original_price (2.0)' END,
      CASE WHEN p_partkey % 9 = 0 THEN who || '''marketing_tags'' should be a list' END,
      CASE WHEN p_partkey % 10 = 0 THEN who || '''image_urls'' should be a list' END) AS warnings FROM p""")
def output_warnings(spark, sf):
    return _checked(spark, sf).select("k", F.array_join("warnings", "|").alias("warnings"))


@register("repeated_keys_and_no_json", "Q6 Q12", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'Product ' || p_partkey || ': Not valid JSON'
      WHEN p_partkey % 2 = 0 THEN 'Product ' || p_partkey || ': Missing required field ''name''' ELSE '' END AS errors FROM part""")
def repeated_keys_and_no_json(spark, sf):
    """Rows that repeat a key keep its last value; rows that are no JSON say so.  Holds in any session."""
    rows = table(spark, sf, "part").selectExpr("p_partkey AS k", """CASE WHEN p_partkey % 5 = 0 THEN concat('none ', p_name)
        ELSE concat('{"name":"', if(p_partkey % 2 = 0, 'first', ''), '","product_id":"', p_partkey, '","scraped_at":1,',
          '"product_url":"https://shop.example/', p_partkey, '","name":"', if(p_partkey % 2 = 0, '', 'last'), '"}') END AS value""")
    return quality.check_output(rows, F.col("k")).select("k", F.array_join("errors", "|").alias("errors"))


@register("output_totals", "Q12", """
    WITH p AS (SELECT p_partkey AS k, p_size, (p_partkey % 7 = 0)::INT + (p_partkey % 11 = 0)::INT + (p_partkey % 3 = 2)::INT AS e,
        (p_partkey % 5 < 2)::INT + (p_partkey % 8 = 0)::INT + (p_partkey % 13 = 0)::INT + (p_partkey % 3 = 1)::INT
        + (p_partkey % 12 = 0)::INT + (p_partkey % 9 = 0)::INT + (p_partkey % 10 = 0)::INT
        + (p_partkey % 4 = 0 AND p_partkey % 5 <> 0 AND p_size + CASE WHEN p_partkey % 5 = 1 THEN 0 ELSE 0.5 END > 2)::INT AS w FROM part)
    SELECT count(*) AS total, count(*) FILTER (e = 0) AS valid, count(*) FILTER (e > 0) AS invalid, sum(e)::BIGINT AS errors,
      sum(w)::BIGINT AS warnings, CAST(NULL AS VARCHAR) AS message FROM p""")
def output_totals(spark, sf):
    return quality.output_totals(_checked(spark, sf))


@register("output_totals_empty", "Q12", """
    SELECT 0::BIGINT AS total, 0::BIGINT AS valid, 0::BIGINT AS invalid, 0::BIGINT AS errors, 0::BIGINT AS warnings,
      'No products to validate' AS message""")
def output_totals_empty(spark, sf):
    return quality.output_totals(quality.check_output(product_json(spark, sf).where("value = 'none'"), F.col("k")))


@register("report_lines", "Q13", """
    WITH e AS (SELECT p_partkey AS k, 0 AS o, 'product_id' AS f FROM part WHERE p_partkey % 7 = 0
        UNION ALL SELECT p_partkey, 1, 'name' FROM part WHERE p_partkey % 11 = 0
        UNION ALL SELECT p_partkey, 2, 'product_url' FROM part WHERE p_partkey % 3 = 2),
      r AS (SELECT *, row_number() OVER (ORDER BY k, o) AS n FROM e)
    SELECT 'Product ' || k || ': Missing required field ''' || f || '''' AS message FROM r WHERE n <= 10
    UNION ALL SELECT '... and ' || (count(*) - 10) || ' more errors' FROM e""")
def report_lines(spark, sf):
    return quality.report_lines(_checked(spark, sf), "errors").select("message")


@register("sample_product", "Q13", "SELECT CAST(p_partkey AS VARCHAR) AS name_key, p_brand AS brand FROM part ORDER BY p_partkey LIMIT 1")
def sample_product(spark, sf):
    return quality.sample_row(table(spark, sf, "part"), F.col("p_partkey")).select(
        F.col("p_partkey").cast("string").alias("name_key"), F.col("p_brand").alias("brand"))

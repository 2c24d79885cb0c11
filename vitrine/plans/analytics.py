"""Queries on the stored products, and the entity datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import entities
from vitrine.plans.registry import register
from vitrine.plans.shapes import price_snapshots, stored_products, table
from vitrine.sources.tables import query


def _sql(spark, sf, text, params=None):
    return query(spark, text, params, products=stored_products(spark, sf))


@register("total_products", "A1", "SELECT count(*) AS total FROM part")
def total_products(spark, sf):
    return _sql(spark, sf, "SELECT count(*) AS total FROM {products}")


@register("products_per_category", "A2", "SELECT p_type AS category, count(*) AS product_count FROM part GROUP BY 1")
def products_per_category(spark, sf):
    return _sql(spark, sf, "SELECT category, count(*) AS product_count FROM {products} GROUP BY category")


@register("average_price_per_category", "A3", "SELECT p_type AS category, round(avg(p_retailprice), 6) AS avg_price FROM part GROUP BY 1")
def average_price_per_category(spark, sf):
    return _sql(spark, sf, "SELECT category, round(avg(price), 6) AS avg_price FROM {products} GROUP BY category")


@register("products_without_images", "A4", "SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS name FROM part WHERE p_partkey % 4 < 2")
def products_without_images(spark, sf):
    return stored_products(spark, sf).where("image_urls IS NULL OR size(image_urls) = 0").select("id", "name")


@register("top_prices", "A5", "SELECT p_partkey AS id, p_retailprice AS price FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")
def top_prices(spark, sf):
    return _sql(spark, sf, "SELECT id, price FROM {products} ORDER BY price DESC, id LIMIT 10")


@register("last_seven_days", "A6", "SELECT p_partkey AS id FROM part WHERE p_partkey % 30 > 22")
def last_seven_days(spark, sf):
    return _sql(spark, sf, """SELECT id FROM {products}
        WHERE created_at > timestamp_ntz'2024-01-30' - INTERVAL 7 DAYS""")


@register("orders_last_seven_days", "A6", """
    SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAYS""")
def orders_last_seven_days(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("snapshots")
    return query(spark, """SELECT o_orderkey FROM snapshots
        WHERE o_orderdate > (SELECT max(o_orderdate) FROM snapshots) - INTERVAL 7 DAYS""")


@register("price_above", "A7 A13", "SELECT p_partkey AS id, p_retailprice AS price FROM part WHERE p_retailprice > 950")
def price_above(spark, sf):
    return _sql(spark, sf, "SELECT id, price FROM {products} WHERE price > ? ORDER BY price DESC", [950])


@register("category_products", "A8 A13", "SELECT p_partkey AS id, p_brand AS brand FROM part WHERE p_type = 'PROMO'")
def category_products(spark, sf):
    return _sql(spark, sf, "SELECT id, brand FROM {products} WHERE category = :category", {"category": "PROMO"})


@register("product_names", "A9", "SELECT CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS name FROM part")
def product_names(spark, sf):
    return stored_products(spark, sf).select("name")


@register("first_five", "A9", "SELECT p_name AS name, p_retailprice AS price FROM part WHERE p_partkey % 11 <> 0 ORDER BY p_partkey LIMIT 5")
def first_five(spark, sf):
    return stored_products(spark, sf).where("name <> ''").orderBy("id").limit(5).select("name", "price")


@register("empty_names", "A10", "SELECT count(*) FILTER (p_partkey % 11 = 0) AS empty_names FROM part")
def empty_names(spark, sf):
    return stored_products(spark, sf).agg(F.count_if(F.col("name") == "").alias("empty_names"))


@register("image_count_histogram", "A11", """
    SELECT CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE p_size END AS image_count, count(*) AS product_count
    FROM part GROUP BY 1""")
def image_count_histogram(spark, sf):
    return stored_products(spark, sf).groupBy(F.size("image_urls").alias("image_count")).agg(
        F.count(F.lit(1)).alias("product_count"))


@register("latest_product", "A14", """
    SELECT count(*) AS total_items, max_by(DATE '2024-01-01' + (p_partkey % 30)::INT, p_partkey)::VARCHAR AS latest_day FROM part""")
def latest_product(spark, sf):
    return stored_products(spark, sf).agg(
        F.count(F.lit(1)).alias("total_items"),
        F.max_by(F.date_format("created_at", "yyyy-MM-dd"), "id").alias("latest_day"))


# ---------------------------------------------------------------------------
# Entities
# ---------------------------------------------------------------------------


_CHANGES = """
    WITH w AS (SELECT o_orderkey AS snapshot_id, o_custkey, o_orderpriority AS region, o_totalprice AS price,
        lag(o_totalprice) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS previous FROM orders)
    SELECT snapshot_id, CAST(o_custkey AS VARCHAR) AS product_id, region, price, previous AS previous_price,
      price - previous AS price_change, coalesce(price < previous, false) AS is_drop FROM w"""


@register("price_changes", "E1", _CHANGES)
def price_changes(spark, sf):
    return entities.price_changes(price_snapshots(spark, sf), at="at", tie="snapshot_id").drop("at")


@register("price_changes_hot_keys", "E1", """
    WITH w AS (SELECT o_orderkey AS snapshot_id, o_orderpriority AS region, o_totalprice AS price,
        lag(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY year(o_orderdate), o_orderkey) AS previous FROM orders)
    SELECT snapshot_id, region, price, previous AS previous_price, price - previous AS price_change,
      coalesce(price < previous, false) AS is_drop FROM w""")
def price_changes_hot_keys(spark, sf):
    """Five products hold all prices, and all prices of a year are of one instant."""
    snapshots = price_snapshots(spark, sf).withColumn("at", F.trunc("at", "year")).drop("product_id")
    return entities.price_changes(snapshots, keys=("region",), at="at", tie="snapshot_id").drop("at")


@register("latest_snapshot", "E2", """
    SELECT CAST(o_custkey AS VARCHAR) AS product_id, o_orderkey AS snapshot_id, o_totalprice AS price FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_snapshot(spark, sf):
    return entities.latest_snapshot(price_snapshots(spark, sf), at="at", tie="snapshot_id").select(
        "product_id", "snapshot_id", "price")


@register("review_rollup", "E3", """
    SELECT p_partkey AS product_id, p_name AS name, round(avg(l_linenumber), 6) AS average_rating,
      count(l_orderkey) AS review_count FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2""")
def review_rollup(spark, sf):
    products = table(spark, sf, "part").selectExpr("p_partkey AS product_id", "p_name AS name")
    reviews = table(spark, sf, "lineitem").selectExpr("l_partkey AS product_id", "l_linenumber AS rating")
    return entities.review_rollup(products, reviews).withColumn("average_rating", F.round("average_rating", 6))


@register("category_counts", "E4", """
    SELECT n_nationkey AS category_id, n_name AS name, 100 + n_regionkey AS parent_category, r_name AS parent_name,
      (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS product_count
    FROM nation JOIN region ON r_regionkey = n_regionkey
    UNION ALL SELECT 100 + r_regionkey, r_name, NULL, NULL, 0 FROM region""")
def category_counts(spark, sf):
    leaves = table(spark, sf, "nation").selectExpr(
        "n_nationkey AS category_id", "n_name AS name", "100 + n_regionkey AS parent_category")
    roots = table(spark, sf, "region").selectExpr(
        "100 + r_regionkey AS category_id", "r_name AS name", "CAST(NULL AS INT) AS parent_category")
    goods = table(spark, sf, "supplier").selectExpr("s_suppkey AS product_id", "s_nationkey AS category_id")
    return entities.category_counts(leaves.unionByName(roots), goods)


@register("store_lookup", "E5", """
    SELECT o_orderkey AS snapshot_id, o_custkey AS store_id, c_name AS store_name, c_mktsegment AS store_city
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def store_lookup(spark, sf):
    stores = table(spark, sf, "customer").selectExpr("c_custkey AS store_id", "c_name AS name", "c_mktsegment AS city")
    rows = table(spark, sf, "orders").selectExpr("o_orderkey AS snapshot_id", "o_custkey AS store_id")
    return entities.with_store(rows, stores)

"""Queries that write products in a format or table and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F, types as T

from vitrine.operators import monitor
from vitrine.plans.registry import register
from vitrine.plans.shapes import crawl_log, dirty_products, table
from vitrine.sources import files, tables
from vitrine.sources.scratch import new_path

_EXPORT = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("in_stock", T.BooleanType()),
    T.StructField("image_urls", T.ArrayType(T.StringType())),
    T.StructField("price_data", T.StructType([
        T.StructField("current", T.DoubleType()), T.StructField("currency", T.StringType())])),
])


def _export(spark, sf):
    """Products with text that needs quoting, nested values and nulls."""
    return table(spark, sf, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "CASE WHEN p_partkey % 5 = 0 THEN concat('\"', p_name, '\", <b> & \\\\ Водка') ELSE p_name END AS name",
        "CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END AS price", "p_partkey % 2 = 0 AS in_stock",
        """CASE p_partkey % 3 WHEN 0 THEN CAST(array() AS ARRAY<STRING>) WHEN 1 THEN array(concat('/a/', p_partkey))
             ELSE array('/b', '/c') END AS image_urls""",
        "named_struct('current', p_retailprice, 'currency', CASE WHEN p_partkey % 4 <> 0 THEN 'RUB' END) AS price_data")


_NAME = """CASE WHEN p_partkey % 5 = 0 THEN '"' || p_name || '", <b> & \\ Водка' ELSE p_name END"""
_PRICE = "CASE WHEN p_partkey % 7 <> 0 THEN p_retailprice END"
_BACK = f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name, {_PRICE} AS price, p_partkey % 2 = 0 AS in_stock,
  CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN '/a/' || p_partkey ELSE '/b|/c' END AS image_urls,
  p_retailprice AS current, CASE WHEN p_partkey % 4 <> 0 THEN 'RUB' END AS currency FROM part"""


def _shown(df):
    return df.select("product_id", "name", "price", "in_stock",
                     F.coalesce(F.array_join("image_urls", "|"), F.lit("")).alias("image_urls"),
                     "price_data.current", "price_data.currency")


def _there_and_back(spark, sf, suffix):
    path = new_path(spark, f"products.{suffix}")
    files.write_products(_export(spark, sf), path)
    return files.read_products(spark, path, schema=_EXPORT)


@register("jsonl_round_trip", "S2 S5 S7", _BACK)
def jsonl_round_trip(spark, sf):
    return _shown(_there_and_back(spark, sf, "jsonl"))


@register("json_round_trip", "S1 S5 S6", _BACK)
def json_round_trip(spark, sf):
    return _shown(_there_and_back(spark, sf, "json"))


@register("json_converted", "S1 S17", f"SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name FROM part")
def json_converted(spark, sf):
    """JSON to JSON Lines, both told by their names and content."""
    source, target = new_path(spark, "products.json"), new_path(spark, "products.jsonl")
    files.write_products(_export(spark, sf), source)
    files.convert(spark, source, target, columns=["product_id", "name"], schema=_EXPORT)
    return files.read_products(spark, target, schema="product_id string, name string")


@register("json_bad_rows", "S2", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, false AS is_bad FROM part WHERE p_partkey % 5 <> 0
    UNION ALL SELECT NULL, true FROM part WHERE p_partkey % 5 = 0""")
def json_bad_rows(spark, sf):
    """Lines cut short keep their row, named as bad."""
    path = new_path(spark, "products.jsonl")
    table(spark, sf, "part").selectExpr("""concat('{"product_id":"', p_partkey,
        CASE WHEN p_partkey % 5 = 0 THEN '"' ELSE '"}' END) AS value""").write.text(path)
    found = files.read_products(spark, path, schema="product_id string", corrupt="_corrupt")
    return found.select(F.when(F.col("_corrupt").isNull(), F.col("product_id")).alias("product_id"),
                        F.col("_corrupt").isNotNull().alias("is_bad"))


@register("json_broken_first_line", "S1 S5", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, false AS is_bad FROM part WHERE p_partkey <> 1
    UNION ALL SELECT NULL, true FROM part WHERE p_partkey = 1""")
def json_broken_first_line(spark, sf):
    """A file of lines whose first line opens an array: that line is told, all others are read."""
    path = new_path(spark, "products.json")
    table(spark, sf, "part").repartitionByRange("p_partkey").sortWithinPartitions("p_partkey").selectExpr(
        """concat(CASE WHEN p_partkey = 1 THEN '[' ELSE '' END, '{"product_id":"', p_partkey,
        CASE WHEN p_partkey = 1 THEN '"' ELSE '"}' END) AS value""").write.text(path)
    found = files.read_products(spark, path, schema="product_id string", corrupt="_corrupt")
    return found.select("product_id", F.col("_corrupt").isNotNull().alias("is_bad"))


@register("xml_round_trip", "S4 S5 S10", _BACK)
def xml_round_trip(spark, sf):
    return _shown(_there_and_back(spark, sf, "xml"))


@register("json_lines_null_fields", "S7", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, true AS has_price_key FROM part WHERE p_partkey % 7 = 0""")
def json_lines_null_fields(spark, sf):
    path = new_path(spark, "products.jsonl")
    files.write_products(_export(spark, sf), path)
    return spark.read.text(path).where(F.expr("get_json_object(value, '$.price') IS NULL")).select(
        F.get_json_object("value", "$.product_id").alias("product_id"), F.col("value").contains('"price":null').alias("has_price_key"))


@register("json_array_files", "S1", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price FROM part""")
def json_array_files(spark, sf):
    """Array files of up to 500 products each; the last file holds a single object."""
    path = new_path(spark, "arrays.json")
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey DIV 500 AS part_no", "to_json(struct(CAST(p_partkey AS STRING) AS product_id, p_name AS name, p_retailprice AS price)) AS doc")
    arrays = rows.groupBy("part_no").agg(F.concat(
        F.lit("[\n"), F.array_join(F.collect_list("doc"), ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part_no").text(path)
    return files.read_products(spark, path, schema="product_id string, name string, price double").drop("part_no")


@register("json_text_order", "S1 S2", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey % 500 AS line FROM part""")
def json_text_order(spark, sf):
    path = new_path(spark, "arrays.json")
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey DIV 500 AS part_no", "p_partkey AS k", "to_json(struct(CAST(p_partkey AS STRING) AS product_id)) AS doc")
    arrays = rows.groupBy("part_no").agg(F.concat(F.lit("["), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("k", "doc"))), lambda d: d["doc"]), ","), F.lit("]")).alias("value"))
    arrays.write.partitionBy("part_no").text(path)
    return files.read_json_text(spark, path).select(
        F.get_json_object("value", "$.product_id").alias("product_id"), F.col("row_order.line").alias("line"))


@register("csv_round_trip", "S3 S5 S8 S9", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name, coalesce(CAST({_PRICE} AS VARCHAR), '') AS price,
      CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS in_stock,
      CASE p_partkey % 3 WHEN 0 THEN '[]' WHEN 1 THEN '["/a/' || p_partkey || '"]' ELSE '["/b","/c"]' END AS image_urls,
      '{{"current":' || p_retailprice || ',"currency":' || CASE WHEN p_partkey % 4 <> 0 THEN '"RUB"' ELSE 'null' END || '}}' AS price_data
    FROM part""")
def csv_round_trip(spark, sf):
    path = new_path(spark, "products.csv")
    files.write_products(_export(spark, sf), path)
    return files.read_products(spark, path)


@register("csv_one_line", "S3 S8", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(replace(text, ' the ', chr(13) || chr(10) || '\\n"' || chr(10)), '') AS text FROM documents""")
def csv_one_line(spark, sf):
    """Texts with line breaks, quotes and backslashes, in CSV files that are read with splits."""
    path = new_path(spark, "texts.csv")
    texts = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit(" the "), F.lit("\r\n\\n\"\n")).alias("text"))
    files.write_products(texts, path, one_line=True)
    return files.read_products(spark, path)


@register("csv_header", "S8", "SELECT 'image_urls,in_stock,name,price,price_data,product_id' AS header, 0 AS marker")
def csv_header(spark, sf):
    path = new_path(spark, "products.csv")
    files.write_products(_export(spark, sf), path)
    return spark.read.text(path).where("value LIKE 'image_urls,%'").distinct().select(
        F.col("value").alias("header"), F.lit(0).alias("marker"))


@register("flattened_values", "S9", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, coalesce(CAST({_PRICE} AS VARCHAR), '') AS price,
      CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS in_stock,
      CASE p_partkey % 3 WHEN 0 THEN '[]' WHEN 1 THEN '["/a/' || p_partkey || '"]' ELSE '["/b","/c"]' END AS image_urls FROM part""")
def flattened_values(spark, sf):
    return files.flatten_rows(_export(spark, sf)).select("product_id", "price", "in_stock", "image_urls")


@register("xml_layout", "S10 S11", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE p_partkey % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 END AS item_count,
      p_name AS _1st_name, p_brand AS "объем__мл_" FROM part""")
def xml_layout(spark, sf):
    rows = table(spark, sf, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "CASE p_partkey % 3 WHEN 0 THEN CAST(array() AS ARRAY<STRING>) WHEN 1 THEN array('a') ELSE array('b', 'c') END AS image_urls",
        "p_name AS `1st Name`", "map('Объем (мл)', p_brand, 'none', CAST(NULL AS STRING)) AS attributes")
    laid = files.to_xml_layout(rows)
    return laid.select("product_id", F.expr("CASE WHEN image_urls IS NOT NULL THEN size(image_urls.item) END").alias("item_count"),
                       "_1st_name", F.col("attributes")["объем__мл_"].alias("объем__мл_"))


@register("element_names", "S11", """
    SELECT n_nationkey AS k, '_' || n_nationkey || '_' || lower(n_name) || '_x' AS name, 'a-b.c_d' AS kept, 'item' AS empty FROM nation""")
def element_names(spark, sf):
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("k"),
        files.element_name_of(F.expr("concat(n_nationkey, ' ', n_name, '!X')")).alias("name"),
        files.element_name_of(F.lit("A-b.C_d")).alias("kept"), files.element_name_of(F.lit("")).alias("empty"))


@register("xml_names", "A16", f"SELECT {_NAME} AS name FROM part")
def xml_names(spark, sf):
    path = new_path(spark, "products.xml")
    files.write_products(_export(spark, sf), path)
    return files.read_products(spark, path, schema=_EXPORT).select("name")


@register("converted_csv", "S17", f"SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name FROM part")
def converted_csv(spark, sf):
    source, middle, target = (new_path(spark, f"products.{s}") for s in ("jsonl", "csv", "jsonl"))
    files.write_products(_export(spark, sf), source)
    files.convert(spark, source, middle, ["product_id", "name"], schema=_EXPORT)
    files.convert(spark, middle, target)
    return files.read_products(spark, target, schema="product_id string, name string")


def _stored(spark, sf):
    """The export rows in a table of their own, appended in two goes."""
    name = f"products_{uuid.uuid4().hex}"
    rows = _export(spark, sf)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    tables.append_products(rows.where("in_stock"), name, created_at=at, path=new_path(spark, "table"))
    tables.append_products(rows.where("NOT in_stock"), name, created_at=at + F.expr("INTERVAL 1 DAY"))
    return name


@register("appended_table", "S12 S13", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_PRICE} AS price,
      '{{"current":' || p_retailprice || ',"currency":' || CASE WHEN p_partkey % 4 <> 0 THEN '"RUB"' ELSE 'null' END || '}}' AS price_data,
      CASE WHEN p_partkey % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS created_on FROM part""")
def appended_table(spark, sf):
    return spark.table(_stored(spark, sf)).select(
        "product_id", "price", "price_data", F.date_format("created_at", "yyyy-MM-dd").alias("created_on"))


@register("table_ids", "S12", "SELECT count(*) AS row_count, count(*) AS id_count, 1::BIGINT AS first_id, true AS later_is_higher FROM part")
def table_ids(spark, sf):
    return spark.table(_stored(spark, sf)).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("id_count"), F.min("id").alias("first_id"),
        (F.max(F.when(F.col("in_stock"), F.col("id"))) < F.min(F.when(~F.col("in_stock"), F.col("id")))).alias("later_is_higher"))


@register("storage_types", "S13", """
    SELECT field, stored_as, CASE WHEN field = 'price' THEN (SELECT count(*) FROM part WHERE p_partkey % 7 <> 0)
      ELSE (SELECT count(*) FROM part) END AS stored FROM (VALUES ('product_id', 'TEXT'), ('name', 'TEXT'), ('price', 'REAL'),
      ('in_stock', 'BOOLEAN'), ('image_urls', 'TEXT'), ('price_data', 'TEXT'), ('count', 'INTEGER')) AS t(field, stored_as)""")
def storage_types(spark, sf):
    df = _export(spark, sf).withColumn("count", F.lit(1))
    stored = tables.storage_projection(df).agg(*[F.count(c).alias(c) for c in df.columns])
    entries = ", ".join(f"'{f.name}', '{tables.storage_type(f.dataType)}', `{f.name}`" for f in df.schema.fields)
    return stored.select(F.expr(f"stack({len(df.columns)}, {entries}) AS (field, stored_as, stored)"))


@register("newest_first_export", "S14", f"SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name, true AS is_in_order FROM part")
def newest_first_export(spark, sf):
    """Each row with a check of its place: older than the row before it in its file."""
    path = new_path(spark, "export.json")
    tables.export_json(spark, path, _stored(spark, sf))
    rows = files.read_json_text(spark, path).select(
        F.from_json("value", "id bigint, product_id string, name string").alias("r"), "row_order")
    before = F.lag("r.id").over(Window.partitionBy("row_order.file").orderBy("row_order"))
    return rows.select("r.product_id", "r.name", F.coalesce(before > F.col("r.id"), F.lit(True)).alias("is_in_order"))


@register("table_csv_export", "S15", f"SELECT CAST(p_partkey AS VARCHAR) AS product_id, {_NAME} AS name FROM part")
def table_csv_export(spark, sf):
    path = new_path(spark, "export.csv")
    tables.export_csv(spark, path, _stored(spark, sf))
    return files.read_products(spark, path).select("product_id", "name")


@register("table_statistics", "A14", "SELECT count(*) AS total_items, '2024-01-02' AS latest_item FROM part")
def table_statistics(spark, sf):
    return tables.table_statistics(spark, _stored(spark, sf)).withColumn(
        "latest_item", F.date_format("latest_item", "yyyy-MM-dd"))


@register("catalog_statistics", "A15", "SELECT count(*) AS items_count, true AS is_listed FROM part")
def catalog_statistics(spark, sf):
    name = _stored(spark, sf)
    return tables.catalog_statistics(spark, name).select(
        "items_count", F.array_contains("tables", name).alias("is_listed"))


@register("category_dimension", "S16", """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 'https://shop.example/category/' || n_name || '/' AS url FROM nation
    UNION ALL SELECT NULL, upper(n_name[1]) || lower(n_name[2:]), 'https://shop.example/category/' || n_name || '/' FROM nation""")
def category_dimension(spark, sf):
    rows = table(spark, sf, "nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS id", "n_name AS name", "concat('https://shop.example/category/', n_name, '/') AS url")
    path = new_path(spark, "categories.json")
    # One small dimension file, as a JSON array.
    rows.agg(F.to_json(F.collect_list(F.struct("id", "name", "url"))).alias("value")).write.text(path)
    return tables.load_categories(spark, path).unionByName(tables.categories_from_urls(rows.select("url")))


@register("saved_run_statistics", "S18", """
    WITH r AS (SELECT 'spider-' || (user_id % 3) AS run, epoch_us(max(ts)) - epoch_us(min(ts)) AS us,
      count(*) FILTER (event_type = 'signup') AS items FROM events GROUP BY 1)
    SELECT run AS spider_name, round(items / (us / 6e7), 2) AS items_per_minute, round(us / 1e6, 2) AS duration_seconds FROM r""")
def saved_run_statistics(spark, sf):
    folder = new_path(spark, "stats")
    summary = monitor.run_summary(crawl_log(spark, sf))
    files.write_run_stats(summary, folder)
    return files.read_run_stats(spark, folder, summary.schema, "spider_name", "items_per_minute", "duration_seconds")


@register("http_log_lines", "A12", """
    WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS INT) AS n FROM events)
    SELECT (400 + n)::INT AS status, count(*) AS line_count FROM e WHERE n % 5 = 3 GROUP BY 1""")
def http_log_lines(spark, sf):
    path = new_path(spark, "scrapy.log")
    crawl_log(spark, sf).selectExpr(
        """concat('2024 ERROR: ', CASE WHEN status IS NULL THEN concat('Timeout on ', event_id)
             ELSE concat('HTTP Error ', status, ' on shop') END) AS value""").write.text(path)
    return monitor.http_errors(spark.read.text(path))


@register("identical_http_lines", "A12", """
    WITH e AS (SELECT CAST(json_extract_string(props, '$.k') AS INT) AS n FROM events)
    SELECT '2024 ERROR: HTTP Error ' || (400 + n) || ' on shop' AS line, count(*) AS line_count FROM e WHERE n % 5 = 3 GROUP BY 1""")
def identical_http_lines(spark, sf):
    path = new_path(spark, "scrapy.log")
    crawl_log(spark, sf).selectExpr(
        """concat('2024 ERROR: ', CASE WHEN status IS NULL THEN concat('Timeout on ', event_id)
             ELSE concat('HTTP Error ', status, ' on shop') END) AS value""").write.text(path)
    return monitor.matching_lines(spark.read.text(path), "HTTP")


@register("rows_per_file_order", "S2", """
    SELECT count(*) AS row_count, count(*) AS distinct_places FROM part""")
def rows_per_file_order(spark, sf):
    path = new_path(spark, "dirty.jsonl")
    dirty_products(spark, sf).write.json(path)
    return files.read_json_text(spark, path).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("row_order").alias("distinct_places"))

"""Stored products: a managed table instead of a database file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_KEPT = (T.BooleanType, T.IntegralType, T.FractionalType, T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)


def storage_type(dtype: T.DataType) -> str:
    """Column type of the store for a value type; nested values are kept as JSON text."""
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, T.IntegralType):
        return "INTEGER"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "REAL"
    return "TEXT"


def storage_projection(df: DataFrame) -> DataFrame:
    """Scalars as they are, everything nested as JSON text."""
    def stored(name: str, dtype: T.DataType) -> Column:
        c = F.col(f"`{name}`")
        if isinstance(dtype, T.NullType):
            return c.cast("string").alias(name)
        if isinstance(dtype, _KEPT):
            return c
        return F.to_json(c, {"ignoreNullFields": "false"}).alias(name)

    return df.select(*[stored(f.name, f.dataType) for f in df.schema.fields])


def _next_id(spark: SparkSession, table: str) -> int:
    if not spark.catalog.tableExists(table):
        return 1
    top = spark.table(table).agg(F.max("id")).first()[0]
    return 1 if top is None else top + 1


def append_products(
    df: DataFrame, table: str = "products", created_at: Column | None = None, path: str | None = None
) -> None:
    """Append rows with a growing ``id`` and ``created_at``.

    Ids are unique and larger than all stored ones, without being dense: a dense
    number would need all rows in one order.  Each append uses up a range of
    2^33 ids per input partition.  One writer per table at a time.
    ``path`` places a new table outside the warehouse folder.
    """
    spark = df.sparkSession
    base = _next_id(spark, table)
    stamped = storage_projection(df).select(
        (F.monotonically_increasing_id() + F.lit(base)).alias("id"), "*",
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"))
    if spark.catalog.tableExists(table):
        stamped = _aligned(stamped, spark.table(table).schema)
    writer = stamped.write.mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order of the table; a new column is an error, a missing one is null."""
    extra = set(df.columns) - set(schema.names)
    if extra:
        raise ValueError(f"columns not in the table: {sorted(extra)}")
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def export_json(spark: SparkSession, path: str, table: str = "products") -> None:
    """Whole table as JSON, newest first: parts are ranges of ``id``."""
    newest_first(spark.table(table)).write.option("ignoreNullFields", False).json(path)


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("id"))


def export_csv(spark: SparkSession, path: str, table: str = "products") -> None:
    """Whole table as CSV, columns in table order."""
    spark.table(table).write.options(header=True, escape='"', emptyValue="").csv(path)


def table_statistics(spark: SparkSession, table: str = "products") -> DataFrame:
    """Number of rows and the ``created_at`` of the row with the highest id."""
    return spark.table(table).agg(
        F.count(F.lit(1)).alias("total_items"), F.max_by("created_at", "id").alias("latest_item"))


def catalog_statistics(spark: SparkSession, table: str = "products") -> DataFrame:
    """Names of the tables, and the number of rows of the products table."""
    names = sorted(t.name for t in spark.catalog.listTables())
    rows = spark.table(table).agg(F.count(F.lit(1)).alias("items_count")) if table in names else \
        spark.range(1).select(F.lit(0).cast("bigint").alias("items_count"))
    return rows.select(F.array(*[F.lit(n) for n in names]).cast("array<string>").alias("tables"), "items_count")


def query(spark: SparkSession, sql: str, params: list | dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with bound parameters.  Errors are raised, not turned into an empty result.

    ``frames`` can be named in braces in the text; the session keeps no view of them.
    """
    return spark.sql(sql, args=params or None, **frames)


# ---------------------------------------------------------------------------
# Category dimension
# ---------------------------------------------------------------------------

CATEGORY_FILE = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "name", "url")])


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    """Category file: a JSON array of id, name, url."""
    return spark.read.schema(CATEGORY_FILE).option("multiLine", True).json(path)


def categories_from_urls(urls: DataFrame) -> DataFrame:
    """Fallback: the name is the second-last part of the path, capitalised; no id."""
    part = F.try_element_at(F.split("url", "/", -1), F.lit(-2))
    name = F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 1 << 30)))
    return urls.select(F.lit(None).cast("string").alias("id"), name.alias("name"), "url")


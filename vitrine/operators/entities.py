"""Price history, reviews, categories and stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from vitrine.sources.scratch import cut_lineage


def price_changes(
    history: DataFrame,
    keys: tuple[str, ...] = ("product_id", "region"),
    at: str = "timestamp",
    price: str = "price",
    tie: str | None = None,
) -> DataFrame:
    """Previous price, change and drop flag of each price of a product.

    The history is put in one order of key, time and tie, dealt out by ranges of
    it.  A range may end anywhere, also between rows of one instant, so a product
    with a third of all prices is as many ranges as its size asks for.  Within a
    range the previous price is that of the row before; the first row of a range
    takes it from the table of range ends, which has one row per range.

    Null keys are a product like others, null times come first, and rows alike in
    key, time and tie follow in any order.
    """
    order = [*keys, at, *([tie] if tie else []), "_row"]
    rows = cut_lineage(
        history.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
        .sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()).drop("_row"))
    ends = rows.groupBy("_part").agg(
        F.min("_place").alias("_first"), F.max_by(F.struct(*keys, F.col(price).alias("_price")), "_place").alias("_last"))
    # one row per range, so one task holds them all
    before = F.lag("_last").over(Window.orderBy("_part"))
    ends = ends.select("_part", "_first", before.alias("_before"))

    within = Window.partitionBy("_part", *keys).orderBy("_place")
    scanned = rows.select("*", F.lag(price).over(within).alias("_lag"), F.row_number().over(within).alias("_nth"))
    goes_on = F.col("_place") == F.col("_first")
    for key in keys:
        goes_on &= F.col(key).eqNullSafe(F.col(f"_before.{key}"))
    previous = F.when(F.col("_nth") > 1, F.col("_lag")).when(goes_on, F.col("_before._price"))
    return scanned.join(ends, "_part").select(
        *history.columns,
        previous.alias("previous_price"),
        (F.col(price) - previous).alias("price_change"),
        F.coalesce(F.col(price) < previous, F.lit(False)).alias("is_drop"),
    )


def latest_snapshot(
    snapshots: DataFrame, key: str = "product_id", at: str = "scraped_at", tie: str | None = None
) -> DataFrame:
    """Newest row per key, by an aggregate that combines before the shuffle."""
    order = F.struct(F.col(at), *([F.col(tie)] if tie else []))
    rest = F.struct(*[F.col(c) for c in snapshots.columns])
    return snapshots.groupBy(key).agg(F.max_by(rest, order).alias("row")).select("row.*")


def review_rollup(products: DataFrame, reviews: DataFrame, key: str = "product_id", rating: str = "rating") -> DataFrame:
    """Products with the mean rating and number of their reviews."""
    rolled = reviews.groupBy(key).agg(
        F.avg(rating).alias("average_rating"), F.count(F.lit(1)).alias("review_count"))
    kept = [c for c in products.columns if c not in ("average_rating", "review_count")]
    return products.select(*kept).join(rolled, key, "left").withColumn(
        "review_count", F.coalesce("review_count", F.lit(0)))


def category_counts(categories: DataFrame, products: DataFrame) -> DataFrame:
    """Categories with their number of products, empty ones included, and the parent's name."""
    counts = products.groupBy("category_id").agg(F.count(F.lit(1)).alias("product_count"))
    parents = categories.select(F.col("category_id").alias("parent_category"), F.col("name").alias("parent_name"))
    kept = [c for c in categories.columns if c != "product_count"]
    return (
        categories.select(*kept)
        .join(counts, "category_id", "left")
        .withColumn("product_count", F.coalesce("product_count", F.lit(0)))
        .join(parents, "parent_category", "left")
    )


def with_store(rows: DataFrame, stores: DataFrame, key: str = "store_id") -> DataFrame:
    """Rows with the columns of their store.

    No hint: Spark broadcasts the store table while its size is below the
    configured threshold and shuffles both sides beyond it.
    """
    columns = [F.col(c).alias(c if c == key else f"store_{c.removeprefix('store_')}") for c in stores.columns]
    return rows.join(stores.select(*columns), key, "left")

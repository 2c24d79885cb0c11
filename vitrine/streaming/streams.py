"""The same operators on unbounded input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators import clean, monitor
from vitrine.sources.scratch import move_path, path_exists, remove_path
from vitrine.sources.tables import storage_projection

#: Rows of a file that compaction writes.
COMPACTED_ROWS = 5_000_000


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", **options) -> DataFrame:
    """A folder that receives files; ``json`` is one object per line."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def events_per_minute(events: DataFrame, late: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Events per type and minute; rows later than ``late`` are left out.

    Append mode emits a window once the watermark has passed it.
    """
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("minute"), "event_type", "event_count")
    )


def clean_stream(
    products: DataFrame, region: str = clean.REGION, source: str | None = None, scraped_at: Column | int | None = None
) -> DataFrame:
    """The cleaning chain as it is: it has no state."""
    return clean.clean_products(products, region=region, source=source, scraped_at=scraped_at)


_LEDGER = "batch_id bigint, first_id bigint, next_id bigint, created_at timestamp"


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per applied or begun batch; a batch that has begun has no ``next_id`` yet."""
    folder = f"{path}/_ledger"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(folder)


def _enter(spark: SparkSession, path: str, batch_id: int, first_id: int, next_id: int | None, created_at) -> None:
    entry = spark.createDataFrame([(batch_id, first_id, next_id, created_at)], _LEDGER)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/_ledger/entry={batch_id}")


def append_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Append one numbered batch to a table folder; a batch that comes again replaces its own rows.

    The ledger of the folder gives each batch the ids behind those of all batches
    before, and the time of its first attempt, so a replay writes the same ids to
    the same place: ``created_day=.../piece=b<batch>``.
    """
    spark = batch.sparkSession
    ledger = _ledger(spark, path)
    entry = ledger.where(F.col("batch_id") == batch_id).select("first_id", "created_at").first()
    if entry is None:
        top = ledger.agg(F.max("next_id").alias("top")).first()["top"]
        entry = (1 if top is None else top, spark.range(1).select(F.current_timestamp()).first()[0])
        _enter(spark, path, batch_id, entry[0], None, entry[1])
    first_id, created_at = entry
    at = F.lit(created_at).cast("timestamp")
    rows = storage_projection(batch).select(
        (F.monotonically_increasing_id() + F.lit(first_id)).alias("id"), "*", at.alias("created_at"),
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.to_date(at).cast("string").alias("created_day"),
        F.lit(f"b{batch_id}").alias("piece"))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("created_day", "piece").parquet(path))
    day = spark.range(1).select(F.to_date(at).cast("string")).first()[0]
    written = f"{path}/created_day={day}/piece=b{batch_id}"
    top = spark.read.parquet(written).agg(F.max("id")).first()[0] if path_exists(spark, written) else None
    _enter(spark, path, batch_id, first_id, first_id if top is None else top + 1, created_at)


def append_stream(products: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to a table folder, each micro-batch exactly once, with ids unique in the table (see :func:`append_batch`).

    Read it with :func:`read_appended`; :func:`compact_appended` joins the files of many batches.
    """
    writer = products.writeStream.foreachBatch(lambda batch, batch_id: append_batch(batch, batch_id, path)).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches; batches that a compacted piece of their day holds are read from that alone."""
    rows = spark.read.parquet(path)
    number = F.substring("piece", 2, 20).cast("bigint")
    held = rows.select("created_day", "piece").distinct().where("piece LIKE 'c%'").groupBy("created_day").agg(
        F.max(number).alias("held"))
    # one row for each day
    marked = rows.join(held.withColumnRenamed("created_day", "held_day"), F.col("created_day") == F.col("held_day"), "left")
    own = F.col("held").isNull() | (number > F.col("held")) | (F.col("piece") == F.concat(F.lit("c"), F.col("held")))
    return marked.where(own).drop("held", "held_day", "created_day", "piece")


def compact_appended(spark: SparkSession, path: str, day: str) -> None:
    """Join the files of all batches of one day (``yyyy-MM-dd``) into one piece.

    Readers see each row once at any moment: a compacted piece counts as soon as
    it is there, and what it replaces is removed after that.
    """
    pieces = [r["piece"] for r in spark.read.parquet(path).where(F.col("created_day") == day).select("piece").distinct().collect()]
    if len(pieces) < 2:
        return
    last = max(int(p[1:]) for p in pieces)
    whole = read_appended(spark, path).where(F.to_date("created_at").cast("string") == day)
    new = f"{path}/_compacting-{day}"
    whole.repartition(1 + whole.count() // COMPACTED_ROWS).write.mode("overwrite").parquet(new)
    move_path(spark, new, f"{path}/created_day={day}/piece=c{last}")
    for piece in pieces:
        if piece != f"c{last}":
            remove_path(spark, f"{path}/created_day={day}/piece={piece}")


def endpoint_states_stream(log: DataFrame) -> DataFrame:
    """Endpoint health as a running aggregate; use update or complete mode.

    Its state has a row for each endpoint ever seen; :func:`endpoint_windows` is bounded.
    """
    return monitor.endpoint_states(log)


def endpoint_windows(log: DataFrame, late: str = "10 minutes", width: str = "1 day") -> DataFrame:
    """Endpoint counts per window, for update mode.

    The stream holds a window until the watermark has passed it, so an endpoint
    that is never seen again leaves the state; events later than ``late`` and
    events without a time are left out.  Times without a zone are read in the
    session's.
    """
    log = log.withColumn("ts", F.col("ts").cast("timestamp_ltz"))
    return (
        log.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "endpoint")
        .agg(*monitor.endpoint_counts(log))
        .select("endpoint", F.col("w.start").alias("window_start"), "total_requests", "successful", "failed", "last_outcome")
    )


def keep_endpoint_windows(
    log: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", width: str = "1 day", once: bool = True
) -> StreamingQuery:
    """Append the windows that each micro-batch changed to a table folder; read them with :func:`kept_endpoint_states`."""
    writer = endpoint_windows(log, late, width).writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: batch.write.mode("append").parquet(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def kept_endpoint_states(spark: SparkSession, path: str) -> DataFrame:
    """Endpoint states over all windows ever kept; a batch written twice counts once."""
    return monitor.combined_states(spark.read.parquet(path))

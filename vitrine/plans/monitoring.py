"""Queries over the crawl log, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import monitor
from vitrine.plans.registry import register
from vitrine.plans.shapes import crawl_log, dirty_products, table
from vitrine.sources.scratch import new_path
from vitrine.streaming import streams

_KIND = """CASE event_type WHEN 'signup' THEN 'item' WHEN 'click' THEN 'request' WHEN 'view' THEN 'response'
    WHEN 'error' THEN 'error' ELSE 'exception' END"""
_RUNS = f"""WITH l AS (SELECT 'spider-' || (user_id % 3) AS run, ts, {_KIND} AS kind FROM events),
  r AS (SELECT run, min(ts) AS a, max(ts) AS b, epoch_us(max(ts)) - epoch_us(min(ts)) AS us, count(*) FILTER (kind = 'item') AS items,
    count(*) FILTER (kind = 'request') AS requests, count(*) FILTER (kind = 'response') AS responses,
    count(*) FILTER (kind = 'exception') AS exceptions, count(*) FILTER (kind = 'error') AS errors FROM l GROUP BY run)"""


@register("run_summary", "M1 M2", f"""{_RUNS}
    SELECT run AS spider_name, strftime(a, '%Y-%m-%dT%H:%M:%S.%f') AS start_time, strftime(b, '%Y-%m-%dT%H:%M:%S.%f') AS end_time,
      round(us / 1e6, 2) AS duration_seconds, round(us / 6e7, 2) AS duration_minutes, items AS items_scraped,
      round(items / (us / 6e7), 2) AS items_per_minute, requests AS request_count, responses AS response_count,
      0::BIGINT AS response_received_count, exceptions AS exception_count, errors AS error_count, 'finished' AS start_reason FROM r""")
def run_summary(spark, sf):
    return monitor.run_summary(crawl_log(spark, sf))


@register("run_rates", "M2 M3", f"""{_RUNS}
    SELECT run AS spider_name, round(items / (us / 6e7), 2) AS items_per_minute, round(responses / requests * 100, 6) AS success_rate,
      round(requests / (round(us / 1e6, 2) / 60), 2) AS requests_per_minute FROM r""")
def run_rates(spark, sf):
    return monitor.with_rates(monitor.run_summary(crawl_log(spark, sf))).select(
        "spider_name", "items_per_minute", F.round("success_rate", 6).alias("success_rate"), "requests_per_minute")


_TYPE = """CASE CAST(json_extract_string(props, '$.k') AS INT) % 5 WHEN 0 THEN 'DNSLookupError' WHEN 1 THEN 'TimeoutError'
    WHEN 2 THEN 'ConnectionRefusedError' WHEN 3 THEN 'HttpError' ELSE 'ValueError' END"""


@register("error_counts", "M4", f"""
    SELECT {_TYPE} AS error_type, count(*) AS error_count FROM events WHERE event_type = 'error' GROUP BY 1""")
def error_counts(spark, sf):
    return monitor.error_counts(crawl_log(spark, sf))


@register("error_details", "M4", f"""
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, {_TYPE} AS type,
      CASE WHEN user_id % 5 <> 0 THEN 'https://shop.example/' || event_id ELSE 'N/A' END AS url, 'value ' || value AS message
    FROM events WHERE event_type = 'error'""")
def error_details(spark, sf):
    return monitor.error_details(crawl_log(spark, sf))


@register("items_per_category", "M5", """
    SELECT 'spider-' || (user_id % 3) AS run, 'cat-' || (user_id % 7) AS category, count(*) AS item_count FROM events
    WHERE event_type = 'signup' GROUP BY 1, 2""")
def items_per_category(spark, sf):
    return monitor.items_per_category(crawl_log(spark, sf))


@register("summary_text", "M6", f"""{_RUNS}, s AS (SELECT *, round(us / 1e6, 2) AS sec FROM r)
    SELECT run AS spider_name, '🎉 *Scraping Job Completed*' || chr(10) || chr(10) || '📊 *Statistics:*' || chr(10) ||
      '• Spider: `' || run || '`' || chr(10) || format('• Duration: {{:.0f}}s ({{:.1f}} min)', sec, sec / 60) || chr(10) ||
      '• Items Scraped: *' || items || '*' || chr(10) || '• Requests: ' || requests || chr(10) ||
      format('• Responses: {{}} ({{:.1f}}%)', responses, responses / requests * 100) || chr(10) || '• Errors: ' || exceptions || chr(10) ||
      '• Status: finished' || chr(10) || chr(10) || '⏱️ *Performance:*' || chr(10) ||
      format('• Items/min: {{:.1f}}', items / (sec / 60)) || chr(10) || format('• Requests/min: {{:.1f}}', requests / (sec / 60)) ||
      chr(10) || chr(10) || '✅ All data exported successfully!' AS message FROM s""")
def summary_text(spark, sf):
    return monitor.summary_text(monitor.run_summary(crawl_log(spark, sf)))


_STATES = """SELECT 'proxy-' || user_id AS endpoint, count(*) AS total_requests, count(*) FILTER (event_type = 'view') AS successful,
    count(*) FILTER (event_type = 'error') AS failed,
    arg_max(event_type, (ts, event_id)) FILTER (event_type IN ('view', 'error')) = 'error' AS is_blacklisted FROM events GROUP BY 1"""


@register("endpoint_states", "M7", _STATES)
def endpoint_states(spark, sf):
    return monitor.endpoint_states(crawl_log(spark, sf))


@register("endpoint_health", "M7", f"""
    WITH s AS ({_STATES}) SELECT sum(total_requests)::BIGINT AS total_requests, sum(successful)::BIGINT AS successful,
      sum(failed)::BIGINT AS failed, count(*) FILTER (is_blacklisted) AS blacklisted,
      count(*) FILTER (NOT coalesce(is_blacklisted, false)) AS available FROM s""")
def endpoint_health(spark, sf):
    return monitor.endpoint_health(monitor.endpoint_states(crawl_log(spark, sf)))


@register("endpoint_health_listed", "M7", f"""
    WITH s AS ({_STATES}), e AS (SELECT DISTINCT 'proxy-' || c_custkey AS endpoint FROM customer)
    SELECT coalesce(sum(total_requests), 0)::BIGINT AS total_requests, coalesce(sum(successful), 0)::BIGINT AS successful,
      coalesce(sum(failed), 0)::BIGINT AS failed, count(*) FILTER (is_blacklisted) AS blacklisted,
      count(*) FILTER (NOT coalesce(is_blacklisted, false)) AS available FROM e LEFT JOIN s USING (endpoint)""")
def endpoint_health_listed(spark, sf):
    known = table(spark, sf, "customer").selectExpr("concat('proxy-', c_custkey) AS endpoint")
    return monitor.endpoint_health(monitor.endpoint_states(crawl_log(spark, sf)), known)


# ---------------------------------------------------------------------------
# Streams: the table's files as a stream, run to the end, result read back
# ---------------------------------------------------------------------------


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    rows = streams.read_stream(spark, sf, schema, fmt="parquet", pathGlobFilter="events.parquet")
    # Event time as an instant: watermarks compare instants.
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ltz"))


@register("stream_events_per_minute", "M8", """
    SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, event_type, count(*) AS event_count
    FROM events GROUP BY 1, 2
    HAVING date_trunc('minute', min(ts)) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_events_per_minute(spark, sf):
    target, checkpoint = new_path(spark, "minutes"), new_path(spark, "checkpoint")
    run = streams.events_per_minute(_event_stream(spark, sf)).writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    run.awaitTermination()
    return spark.read.schema("minute timestamp, event_type string, event_count bigint").parquet(target).select(
        F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "event_type", "event_count")


@register("events_per_minute", "M8", """
    SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, event_type, count(*) AS event_count
    FROM events GROUP BY 1, 2""")
def events_per_minute(spark, sf):
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp_ltz"))
    return streams.events_per_minute(rows).select(
        F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "event_type", "event_count")


_CLEANED = """WITH d AS (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN -p_retailprice WHEN p_partkey % 10 = 3 THEN p_retailprice * 3
      WHEN p_partkey % 21 = 0 THEN NULL ELSE p_retailprice END AS price,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN -1 ELSE p_retailprice + p_size END AS original FROM part
    WHERE p_partkey % 97 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 89 <> 0 AND p_partkey % 83 <> 0)
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
    CASE WHEN price > original THEN greatest(original, 0) WHEN price < 0 THEN 0 ELSE price END AS price FROM d"""


def _product_stream(spark, sf):
    """Dirty products as JSON Lines files, read back as a stream."""
    folder = new_path(spark, "dirty.jsonl")
    rows = dirty_products(spark, sf)
    rows.write.option("ignoreNullFields", False).json(folder)
    return streams.read_stream(spark, folder, rows.schema)


@register("stream_clean", "M9", _CLEANED)
def stream_clean(spark, sf):
    target, checkpoint = new_path(spark, "clean"), new_path(spark, "checkpoint")
    cleaned = streams.clean_stream(_product_stream(spark, sf), scraped_at=1)
    cleaned.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start(target).awaitTermination()
    return spark.read.schema(cleaned.schema).parquet(target).select("product_id", "name", "category", "price")


@register("stream_append", "M10 S12", _CLEANED)
def stream_append(spark, sf):
    target, checkpoint = new_path(spark, "table"), new_path(spark, "checkpoint")
    streams.append_stream(
        streams.clean_stream(_product_stream(spark, sf), scraped_at=1), target, checkpoint).awaitTermination()
    return streams.read_appended(spark, target).select("product_id", "name", "category", "price")


@register("stream_append_replayed", "M10", "SELECT count(*) AS n_rows, count(*) AS n_ids, 3 AS n_batches FROM part")
def stream_append_replayed(spark, sf):
    """Three batches, the second applied twice as after a lost driver: every row once, all ids distinct."""
    target = new_path(spark, "table")
    rows = table(spark, sf, "part").selectExpr("CAST(p_partkey AS STRING) AS product_id", "p_name AS name", "p_partkey % 3 AS b")
    for batch_id in (0, 1, 1, 2):
        streams.append_batch(rows.where(F.col("b") == batch_id).drop("b"), batch_id, target)
    return streams.read_appended(spark, target).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.countDistinct("batch_id").cast("int").alias("n_batches"))


def _outcome_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return streams.read_stream(spark, sf, schema, fmt="parquet", pathGlobFilter="events.parquet").selectExpr(
        "event_id", "ts", "concat('proxy-', user_id) AS endpoint",
        "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'success' ELSE 'sent' END AS outcome")


@register("stream_endpoint_states", "M11", _STATES)
def stream_endpoint_states(spark, sf):
    target, checkpoint = new_path(spark, "states"), new_path(spark, "checkpoint")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(target)

    streams.endpoint_states_stream(_outcome_stream(spark, sf)).writeStream.outputMode("complete").foreachBatch(keep).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target)


@register("stream_endpoint_windows", "M11", _STATES)
def stream_endpoint_windows(spark, sf):
    target, checkpoint = new_path(spark, "windows"), new_path(spark, "checkpoint")
    streams.keep_endpoint_windows(_outcome_stream(spark, sf), target, checkpoint).awaitTermination()
    return streams.kept_endpoint_states(spark, target)

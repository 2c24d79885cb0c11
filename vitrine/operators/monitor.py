"""Run, error and endpoint figures from an event log.

The log has ``run``, ``ts`` (timestamp), ``kind`` and, where they apply,
``event_id``, ``endpoint``, ``category``, ``url``, ``error_type``, ``message``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

ITEM, REQUEST, RESPONSE, RECEIVED, EXCEPTION, ERROR = (
    "item", "request", "response", "response_received", "exception", "error")


def _kind(name: str) -> Column:
    return F.count_if(F.col("kind") == name)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp_ltz")) - F.unix_micros(start.cast("timestamp_ltz"))) / 1e6


def per_minute(amount: Column, seconds: Column) -> Column:
    """Amount per minute of the duration; 0 when there was none."""
    return F.when(seconds > 0, F.round(amount / (seconds / 60), 2)).otherwise(F.lit(0.0))


def success_rate(responses: Column, requests: Column) -> Column:
    return F.when(requests > 0, responses / requests * 100).otherwise(F.lit(0.0))


def run_summary(log: DataFrame, reason: Column | None = None) -> DataFrame:
    """One row per run; hot runs are combined before the shuffle."""
    rows = log.groupBy("run").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        _kind(ITEM).alias("items_scraped"), _kind(REQUEST).alias("request_count"),
        _kind(RESPONSE).alias("response_count"), _kind(RECEIVED).alias("response_received_count"),
        _kind(EXCEPTION).alias("exception_count"), _kind(ERROR).alias("error_count"),
    )
    rows = rows.withColumn("seconds", seconds_between(F.col("first_ts"), F.col("last_ts")))
    return rows.select(
        F.col("run").alias("spider_name"),
        F.date_format("first_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("start_time"),
        F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("end_time"),
        F.round("seconds", 2).alias("duration_seconds"),
        F.round(F.col("seconds") / 60, 2).alias("duration_minutes"),
        "items_scraped", per_minute(F.col("items_scraped"), F.col("seconds")).alias("items_per_minute"),
        "request_count", "response_count", "response_received_count", "exception_count", "error_count",
        (F.lit("finished") if reason is None else reason).alias("start_reason"),
    )


def with_rates(summary: DataFrame) -> DataFrame:
    """The summary plus the success rate and the requests per minute."""
    return summary.select(
        "*",
        success_rate(F.col("response_count"), F.col("request_count")).alias("success_rate"),
        per_minute(F.col("request_count"), F.col("duration_seconds")).alias("requests_per_minute"),
    )


def error_counts(log: DataFrame) -> DataFrame:
    """Errors per type."""
    return log.where(F.col("kind") == ERROR).groupBy("error_type").agg(F.count(F.lit(1)).alias("error_count"))


def error_details(log: DataFrame) -> DataFrame:
    """One row per error: time, type, address (``N/A`` when unknown), message."""
    return log.where(F.col("kind") == ERROR).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("error_type").alias("type"), F.coalesce("url", F.lit("N/A")).alias("url"), "message")


def items_per_category(log: DataFrame) -> DataFrame:
    return log.where(F.col("kind") == ITEM).groupBy("run", "category").agg(F.count(F.lit(1)).alias("item_count"))


def summary_text(summary: DataFrame) -> DataFrame:
    """A readable report per run."""
    s = F.col
    rate = success_rate(s("response_count"), s("request_count"))
    speed = lambda c: F.when(s("duration_seconds") > 0, c / (s("duration_seconds") / 60)).otherwise(F.lit(0.0))
    # Fixed value: the layout of the report.
    layout = (
        "🎉 *Scraping Job Completed*\n\n"
        "📊 *Statistics:*\n"
        "• Spider: `%s`\n"
        "• Duration: %.0fs (%.1f min)\n"
        "• Items Scraped: *%d*\n"
        "• Requests: %d\n"
        "• Responses: %d (%.1f%%)\n"
        "• Errors: %d\n"
        "• Status: %s\n\n"
        "⏱️ *Performance:*\n"
        "• Items/min: %.1f\n"
        "• Requests/min: %.1f\n\n"
        "✅ All data exported successfully!"
    )
    return summary.select("spider_name", F.format_string(
        layout, s("spider_name"), s("duration_seconds").cast("double"), s("duration_seconds") / 60, s("items_scraped"),
        s("request_count"), s("response_count"), rate, s("exception_count"), s("start_reason"),
        speed(s("items_scraped")), speed(s("request_count"))).alias("message"))


# ---------------------------------------------------------------------------
# Endpoint health
# ---------------------------------------------------------------------------

SUCCESS, FAILED = "success", "failed"


def outcome_order(log: DataFrame) -> Column:
    """Time, ``event_id`` and outcome of a success or failure as one number; null for other events.

    A number of fixed width is what a hash aggregate can keep in place; a struct
    would make it sort.  Micros since the year 1 and the id lie above the last
    digit pair by pair, null before all others; the number is odd for a failure.
    Times beyond the year 9999 raise.
    """
    if isinstance(log.schema["ts"].dataType, T.TimestampNTZType):
        micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    else:
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first = -62_135_596_800_000_000  # the year 1
    place = F.coalesce(micros - F.lit(first) + 1, F.lit(0)).cast("decimal(18,0)")
    event = F.coalesce(F.col("event_id").cast("bigint").cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
    failure = (F.col("outcome") == FAILED).cast("int")
    number = (place * F.lit(Decimal(2 * 10**19)) + event.cast("decimal(20,0)")) * F.lit(Decimal(2)) + failure
    return F.when(F.col("outcome").isin(SUCCESS, FAILED), number.cast("decimal(38,0)"))


def endpoint_counts(log: DataFrame) -> list[Column]:
    """Requests by outcome and the last success or failure (see :func:`outcome_order`)."""
    return [
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("outcome") == SUCCESS).alias("successful"),
        F.count_if(F.col("outcome") == FAILED).alias("failed"),
        F.max(outcome_order(log)).alias("last_outcome"),
    ]


def endpoint_states(log: DataFrame) -> DataFrame:
    """Per endpoint: requests by outcome, and whether the last outcome was a failure.

    ``log`` has ``endpoint``, ``outcome``, ``ts`` and the unique whole number
    ``event_id`` that orders events of one instant.
    """
    return with_blacklist(log.groupBy("endpoint").agg(*endpoint_counts(log)))


def with_blacklist(counts: DataFrame) -> DataFrame:
    """The last outcome as a flag: null for an endpoint with neither success nor failure."""
    return counts.select(
        "endpoint", "total_requests", "successful", "failed", (F.col("last_outcome") % 2 == 1).alias("is_blacklisted"))


def combined_states(parts: DataFrame) -> DataFrame:
    """Endpoint states from the counts of windows, each window as often as it was told.

    Counts and last outcome of a window only grow, so the largest of each is its
    newest state, in whatever order the rows came and however often they repeat.
    """
    figures = ("total_requests", "successful", "failed", "last_outcome")
    newest = parts.groupBy("endpoint", "window_start").agg(*[F.max(c).alias(c) for c in figures])
    return with_blacklist(newest.groupBy("endpoint").agg(
        *[F.sum(c).alias(c) for c in figures[:3]], F.max("last_outcome").alias("last_outcome")))


def endpoint_health(states: DataFrame, endpoints: DataFrame | None = None) -> DataFrame:
    """Totals over all endpoints; ``endpoints`` adds those that were never used."""
    if endpoints is not None:
        states = endpoints.select("endpoint").distinct().join(states, "endpoint", "left")
    bad = F.coalesce("is_blacklisted", F.lit(False))
    return states.agg(
        F.coalesce(F.sum("total_requests"), F.lit(0)).alias("total_requests"),
        F.coalesce(F.sum("successful"), F.lit(0)).alias("successful"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        F.count_if(bad).alias("blacklisted"),
        F.count_if(~bad).alias("available"),
    )


# ---------------------------------------------------------------------------
# Text logs
# ---------------------------------------------------------------------------


def matching_lines(lines: DataFrame, word: str, text: str = "value") -> DataFrame:
    """Lines that contain the word, with the number of identical ones."""
    return lines.where(F.col(text).contains(word)).groupBy(F.col(text).alias("line")).agg(
        F.count(F.lit(1)).alias("line_count"))


def http_errors(lines: DataFrame, text: str = "value") -> DataFrame:
    """HTTP error lines per status code."""
    status = F.regexp_extract(F.col(text), r"HTTP Error (\d+)", 1).try_cast("int")
    return lines.select(status.alias("status")).where("status IS NOT NULL").groupBy("status").agg(
        F.count(F.lit(1)).alias("line_count"))

"""A Spark session with the settings this package is tuned for.

Any session works; these are the values worth setting on a cluster too.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan joins and partition counts from run-time sizes; split skewed join sides.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages per Arrow batch are bounded by bytes, so large pages cannot exhaust a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    "spark.sql.session.timeZone": "UTC",
    # An object with a repeated key keeps the last value instead of being no JSON at all.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Call-site capture doubles the cost of building large expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("vitrine")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

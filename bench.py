"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to the end into the ``noop`` sink, which computes
every row and column.  The time is the better of two runs after one warm-up of
the session, so it is the time of the query and not of starting the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitrine.plans import catalogue  # noqa: E402
from vitrine.session import build_session  # noqa: E402

HEADLINE = (
    "cleaned_products", "correction_summary", "category_prices_cleaned", "clean_descriptions", "discount",
    "line_price_fix", "field_statistics", "required_completeness", "json_field_statistics", "output_totals",
    "page_nodes", "resolved_links", "links_fetched_once", "selector_coverage", "product_links", "attributed_pages",
    "page_depth", "characteristics", "gallery_images", "product_rows", "pages_to_clean_products",
    "price_changes", "latest_snapshot", "review_rollup", "store_lookup", "run_summary", "endpoint_states",
    "jsonl_round_trip", "csv_round_trip", "xml_round_trip", "appended_table", "stream_clean",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.QUERIES["total_products"](spark, sf_dir).collect()
    catalogue.QUERIES["page_nodes"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

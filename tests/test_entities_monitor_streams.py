import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vitrine.operators import entities, monitor
from vitrine.streaming import streams


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_price_changes_do_not_depend_on_ranges(spark, parts):
    """One product, and one instant of it, spread over many ranges; some ranges stay empty."""
    rng = random.Random(1)
    rows = []
    for n in range(900):
        product = rng.choice(["hot", "hot", None, f"p{rng.randrange(40)}"])
        at = datetime(2024, 1, 1) + timedelta(days=rng.choice((0, 0, rng.randrange(400))))
        rows.append((n, product, rng.choice(["r1", "r2", None]) if product != "hot" else "r1",
                     rng.choice([1.0, 2.0, 3.0, None]), at if n % 50 else None))
    df = spark.createDataFrame(rows, "id int, product_id string, region string, price double, timestamp timestamp")
    last, want = {}, {}
    for n, product, region, price, at in sorted(rows, key=lambda r: (r[4] or datetime(1900, 1, 1), r[0])):
        before = last.get((product, region))
        want[n] = (before, price - before if None not in (before, price) else None,
                   before is not None and price is not None and price < before)
        last[(product, region)] = price
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    usual = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, (str(parts), "false")):
            spark.conf.set(name, value)
        got = entities.price_changes(df, tie="id").collect()
    finally:
        for name, value in zip(names, usual):
            spark.conf.set(name, value)
    assert {r["id"]: (r["previous_price"], r["price_change"], r["is_drop"]) for r in got} == want and len(got) == 900


def test_price_changes_of_no_rows_and_of_equal_rows(spark):
    kind = "product_id string, region string, price double, timestamp timestamp"
    assert entities.price_changes(spark.createDataFrame([], kind)).count() == 0
    same = spark.createDataFrame([("a", "r", 2.0, datetime(2024, 1, 1))] * 50, kind)
    got = sorted((r["previous_price"] is None, r["previous_price"], r["is_drop"]) for r in entities.price_changes(same).collect())
    assert got == [(False, 2.0, False)] * 49 + [(True, None, False)]


def test_latest_reviews_categories_stores(spark):
    snaps = spark.createDataFrame([("a", 1, 5.0, 1), ("a", 2, 6.0, 2), ("a", 2, 7.0, 3), ("b", 1, 1.0, 4)], "product_id string, scraped_at int, price double, n int")
    assert {r["product_id"]: r["price"] for r in entities.latest_snapshot(snaps, tie="n").collect()} == {"a": 7.0, "b": 1.0}
    products = spark.createDataFrame([("a", "c1"), ("b", "c1"), ("z", None)], "product_id string, category_id string")
    reviews = spark.createDataFrame([("a", 4), ("a", 5)], "product_id string, rating int")
    got = {r["product_id"]: (r["average_rating"], r["review_count"]) for r in entities.review_rollup(products, reviews).collect()}
    assert got == {"a": (4.5, 2), "b": (None, 0), "z": (None, 0)}
    cats = spark.createDataFrame([("c1", "One", None), ("c2", "Two", "c1")], "category_id string, name string, parent_category string")
    got = {r["category_id"]: (r["product_count"], r["parent_name"]) for r in entities.category_counts(cats, products).collect()}
    assert got == {"c1": (2, None), "c2": (0, "One")}
    stores = spark.createDataFrame([("c1", "Shop")], "store_id string, name string")
    assert entities.with_store(products.withColumnRenamed("category_id", "store_id"), stores).where("store_name = 'Shop'").count() == 2


LOG = "run string, ts timestamp, kind string, error_type string, url string, message string, category string"


def test_run_summary(spark):
    at = datetime(2024, 12, 3, 15, 30)
    rows = [("s", at, "request", None, None, None, None), ("s", at + timedelta(seconds=930), "item", None, None, None, "c"),
            ("s", at, "response", None, None, None, None), ("s", at, "request", None, None, None, None),
            ("s", at, "error", "KeyError", None, "boom", None), ("once", at, "item", None, None, None, "c")]
    log = spark.createDataFrame(rows, LOG)
    got = {r["spider_name"]: r for r in monitor.with_rates(monitor.run_summary(log)).collect()}
    s = got["s"]
    assert (s["duration_seconds"], s["duration_minutes"], s["items_per_minute"], s["success_rate"], s["error_count"]) == (930.0, 15.5, 0.06, 50.0, 1)
    assert got["once"]["items_per_minute"] == 0.0 and got["once"]["success_rate"] == 0.0
    text = {r["spider_name"]: r["message"] for r in monitor.summary_text(monitor.run_summary(log)).collect()}["s"]
    assert "• Duration: 930s (15.5 min)" in text and "• Responses: 1 (50.0%)" in text
    assert tuple(monitor.error_details(log).select("type", "url", "message").collect()[0]) == ("KeyError", "N/A", "boom")


def test_endpoint_health(spark):
    at = datetime(2024, 1, 1)
    rows = [("a", "failed", 1), ("a", "success", 2), ("b", "success", 1), ("b", "failed", 3), ("c", "sent", 1), ("c", "failed", 1), ("c", "success", 1)]
    log = spark.createDataFrame([(e, o, at + timedelta(seconds=s), i) for i, (e, o, s) in enumerate(rows)],
                                "endpoint string, outcome string, ts timestamp, event_id int")
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("unused",)], "endpoint string")
    assert tuple(monitor.endpoint_health(monitor.endpoint_states(log), known).collect()[0]) == (7, 3, 3, 1, 3)


def states_by_hand(events):
    """Counts and last outcome per endpoint, null times and ids first."""
    states = {}
    for endpoint, outcome, ts, event_id in sorted(events, key=lambda e: (e[2] is not None, e[2] or 0, e[3] is not None, e[3] or 0)):
        total, ok, bad, last = states.get(endpoint, (0, 0, 0, None))
        known = outcome in ("success", "failed")
        states[endpoint] = (total + 1, ok + (outcome == "success"), bad + (outcome == "failed"), (outcome == "failed") if known else last)
    return states


@pytest.mark.parametrize("time", ["timestamp", "timestamp_ntz"])
def test_endpoint_states_against_brute_force(spark, time):
    rng = random.Random(8)
    times = [None, datetime(1, 1, 2), datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(2024, 3, 31, 2, 30), datetime(9999, 12, 30)]
    ids = [None, -2**63, -1, 0, 2**63 - 1, *range(10, 400)]
    rng.shuffle(ids)
    events = [(rng.choice("abcd"), rng.choice(["success", "failed", "sent", None]), rng.choice(times), i) for i in ids]
    events += [(None, "failed", times[3], 1000), ("only sent", "sent", times[3], 1001)]
    log = spark.createDataFrame(events, f"endpoint string, outcome string, ts {time}, event_id bigint")
    states = monitor.endpoint_states(log)
    assert {r[0]: tuple(r)[1:] for r in states.collect()} == states_by_hand(events)
    assert "SortAggregate" not in states._jdf.queryExecution().executedPlan().toString()
    assert monitor.endpoint_states(log.limit(0)).collect() == []


def test_endpoint_windows_forget_endpoints(spark, folder):
    from pyspark.sql.types import StructType
    schema = "endpoint string, outcome string, ts timestamp, event_id bigint"
    at = datetime(2024, 1, 1)
    hours = ([1, 0.5], [30, 2], [29, 28], [60], [3, 61, 59.9], [100], [101])  # hour 3 comes after its window has closed
    batches = [[(f"e{n}{i}" if i % 2 else "steady", "failed" if (n + i) % 3 else "success", at + timedelta(hours=h), 10 * n + i)
                for i, h in enumerate(own)] for n, own in enumerate(hours)]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{folder}/in{n}")
    stream = streams.read_stream(spark, f"{folder}/in*", StructType.fromDDL(schema), maxFilesPerTrigger=1)
    query = streams.keep_endpoint_windows(stream, f"{folder}/out", f"{folder}/check", width="6 hours")
    query.awaitTermination()
    want = states_by_hand([e for rows in batches for e in rows if e[3] != 40])
    got = {r[0]: tuple(r)[1:] for r in streams.kept_endpoint_states(spark, f"{folder}/out").collect()}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(got) < 9 and got == want, held
    assert max(held) > held[-1] and held[-1] <= 2  # seven endpoints came, state holds the open window alone
    # the same rows again, as after a lost driver, change nothing
    again = spark.read.parquet(f"{folder}/out")
    assert {r[0]: tuple(r)[1:] for r in monitor.combined_states(again.unionByName(again)).collect()} == got


def test_late_events_are_left_out(spark, folder):
    schema = "ts timestamp, event_type string"
    at = datetime(2024, 1, 1, 12)
    for n, minutes in enumerate(([0, 0, 1], [40], [41], [2, 42], [90], [91])):
        spark.createDataFrame([(at + timedelta(minutes=m), "x") for m in minutes], schema).coalesce(1).write.mode("append").json(f"{folder}/in{n}")
    from pyspark.sql.types import StructType
    stream = streams.read_stream(spark, f"{folder}/in*", StructType.fromDDL(schema), maxFilesPerTrigger=1)
    query = streams.events_per_minute(stream).writeStream.format("memory").queryName("minutes").outputMode("append").trigger(
        availableNow=True).start()
    query.awaitTermination()
    got = {(r["minute"] - at).seconds // 60: r["event_count"] for r in spark.table("minutes").collect()}
    assert got == {0: 2, 1: 1, 40: 1, 41: 1, 42: 1}  # minute 2 came after the watermark had passed it


def test_append_stream_is_idempotent(spark, folder):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("product_id string, name string, product_url string, scraped_at bigint, tags array<string>")
    for n in range(2):
        spark.createDataFrame([(f"{n}{i}", f" N  {i}", "https://e", 1, ["b", "a"]) for i in range(5)], schema).write.mode("append").json(f"{folder}/in")
    stream = streams.clean_stream(streams.read_stream(spark, f"{folder}/in", schema, maxFilesPerTrigger=1))
    streams.append_stream(stream, f"{folder}/out", f"{folder}/check").awaitTermination()
    streams.append_stream(stream, f"{folder}/out", f"{folder}/check").awaitTermination()
    rows = spark.read.parquet(f"{folder}/out")
    assert rows.count() == 10 and rows.where("name LIKE 'N _'").count() == 10 and rows.select("tags").distinct().collect()[0][0] == '["a","b"]'
    # The same batches again, as after a lost driver: each replaces its own partition.
    streams.append_stream(stream, f"{folder}/out", f"{folder}/check-again").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 10
    assert spark.read.parquet(f"{folder}/out").select(F.count_distinct("batch_id")).collect()[0][0] >= 2


def test_appended_batches_are_replayed_and_compacted(spark, folder):
    path = f"{folder}/table"

    def batch(names):
        return spark.createDataFrame([(n,) for n in names], "name string").repartition(3)

    for batch_id, names in ((0, "abc"), (1, "defg"), (1, "defg"), (2, ""), (3, "h")):
        streams.append_batch(batch(names), batch_id, path)
    before = sorted(tuple(r) for r in streams.read_appended(spark, path).select("id", "name", "batch_id").collect())
    assert sorted(r[1] for r in before) == list("abcdefgh") and len({r[0] for r in before}) == 8
    assert [r[2] for r in before] == [0] * 3 + [1] * 4 + [3]  # ids grow with the batches
    day = streams.read_appended(spark, path).selectExpr("string(to_date(created_at))").first()[0]
    for _ in range(2):
        streams.compact_appended(spark, path, day)
        assert sorted(tuple(r) for r in streams.read_appended(spark, path).select("id", "name", "batch_id").collect()) == before
    assert spark.read.parquet(path).select("piece").distinct().collect() == [("c3",)]
    streams.append_batch(batch("ij"), 4, path)
    after = streams.read_appended(spark, path).select("id", "name").collect()
    assert len(after) == len({r["id"] for r in after}) == 10
    streams.compact_appended(spark, path, day)
    assert streams.read_appended(spark, path).count() == 10

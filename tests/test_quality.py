import json

import pytest
from pyspark.sql import functions as F

from vitrine.operators import quality

ROWS = [
    {"product_id": "1", "name": "a", "product_url": "https://e/1", "scraped_at": 5, "price": 2.5, "original_price": 3, "tags": ["x"], "ok": True},
    {"product_id": "", "name": "b", "product_url": "nope", "scraped_at": "5", "price": "9", "original_price": 1, "rating": -1, "marketing_tags": "x"},
    {"name": None, "price": -1, "scraped_at": 1.5, "image_url": "/x", "image_urls": {"a": 1}, "review_count": 0, "ok": None},
]


def raw(spark, rows=ROWS):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, value string").coalesce(1)


def test_output_check(spark):
    got = quality.check_output(raw(spark), F.col("i")).orderBy("i").collect()
    assert got[0]["errors"] == [] and got[0]["warnings"] == []
    assert got[1]["errors"] == ["Product 1: Missing required field 'product_id'"]
    assert got[1]["warnings"] == [
        "Product 1: Field 'price' has type str, expected float or int", "Product 1: Field 'scraped_at' has type str, expected int",
        "Product 1: Field 'product_url' has invalid URL: nope", "Product 1: Price (9.0) > original_price (1.0)",
        "Product 1: 'marketing_tags' should be a list"]
    assert [e.split("'")[1] for e in got[2]["errors"]] == ["product_id", "name", "product_url"]
    assert got[2]["warnings"] == [
        "Product 2: Field 'price' is negative: -1", "Product 2: Field 'scraped_at' has type float, expected int",
        "Product 2: Field 'image_url' has invalid URL: /x", "Product 2: 'image_urls' should be a list"]
    totals = quality.output_totals(quality.check_output(raw(spark), F.col("i"))).collect()[0]
    assert tuple(totals) == (3, 1, 2, 4, 9, None)


def test_report_lines(spark):
    many = quality.check_output(raw(spark, [{}] * 4), F.col("i"))
    lines = [r["message"] for r in quality.report_lines(many, "errors").collect()]
    assert len(lines) == 11 and lines[0] == "Product 0: Missing required field 'product_id'" and lines[-1] == "... and 6 more errors"
    few = [r["message"] for r in quality.report_lines(quality.check_output(raw(spark, [{}]), F.col("i")), "errors").collect()]
    assert len(few) == 4


def test_json_field_stats(spark):
    got = {r["field"]: (r["filled"], r["non_null"], r["total"], r["type"]) for r in quality.json_field_stats(raw(spark), F.col("i")).collect()}
    assert got["price"] == (3, 3, 3, "float") and got["scraped_at"] == (3, 3, 3, "integer") and got["tags"] == (1, 1, 3, "array")
    assert got["name"] == (2, 2, 3, "string") and got["image_urls"] == (1, 1, 3, "object") and got["ok"] == (1, 1, 3, "boolean")
    assert got["review_count"] == (0, 1, 3, "integer") and got["product_id"] == (1, 2, 3, "string")


def test_completeness_and_advice(spark):
    df = spark.createDataFrame([("1", "a", 0), ("2", "", 5), ("3", "c", None)], "product_id string, name string, n int")
    rows = {r["field"]: r for r in quality.completeness(df, ("product_id", "name", "gone")).collect()}
    assert rows["product_id"]["found"] and rows["name"]["message"] == "Field 'name' missing in 1 items" and rows["gone"]["filled"] == 0
    stats = {r["field"]: (r["filled"], r["non_null"], round(r["percentage"], 1)) for r in quality.field_stats(df).collect()}
    assert stats == {"product_id": (3, 3, 100.0), "name": (2, 3, 66.7), "n": (1, 2, 33.3)}
    advice = [r[0] for r in quality.recommendations(quality.validity(df, required=("name",)), quality.field_stats(df)).collect()]
    assert advice[0].startswith("High number of invalid items (33.3%)") and "Field 'n' has only 33.3% filled" in advice[1] and len(advice) == 2


def test_one_pass(spark):
    plan = quality.completeness(raw(spark).withColumn("name", F.lit("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_repeated_keys_and_unreadable_rows_in_any_session(spark, allowed):
    whole = '"product_id":"1","name":"a","product_url":"https://e.com/1","scraped_at":5'
    rows = [(0, f'{{"name":"",{whole}}}'), (1, "not json"), (2, f'{{{whole},"name":null,"price":"x","price":-1}}'), (3, None)]
    df = spark.createDataFrame(rows, "i int, value string")
    name = "spark.sql.variant.allowDuplicateKeys"
    usual = spark.conf.get(name)
    try:
        spark.conf.set(name, allowed)
        got = {r["i"]: (r["errors"], r["warnings"]) for r in quality.check_output(df, F.col("i")).collect()}
        stats = {r["field"]: (r["filled"], r["total"]) for r in quality.json_field_stats(df, F.col("i")).collect()}
    finally:
        spark.conf.set(name, usual)
    assert got[0] == ([], [])
    assert got[1][0] == ["Product 1: Not valid JSON"] and got[3][0] == ["Product 3: Not valid JSON"]
    assert got[2][0] == ["Product 2: Missing required field 'name'"] and "is negative" in got[2][1][0]
    assert stats["name"] == (1, 2) and stats["price"] == (1, 2)

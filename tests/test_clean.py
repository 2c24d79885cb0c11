import pytest
from pyspark.sql import functions as F

from vitrine.operators import clean
from vitrine.operators.conform import conform
from vitrine.schemas import ENTITIES, PRODUCT, VARIANTS

GOOD = {"product_id": "12345", "name": "Vodka Absolut", "product_url": "https://example.com/product", "scraped_at": 1234567890}
BASE = "product_id string, name string, product_url string, scraped_at bigint"


def frame(spark, schema="", **fields):
    row = {**GOOD, **fields}
    return spark.createDataFrame([row], BASE + (", " + schema if schema else "")).coalesce(1)


def first(df):
    return df.collect()[0].asDict(True)


@pytest.mark.parametrize("field", list(GOOD))
def test_required_fields(spark, field):
    bad = frame(spark, **{field: None})
    assert clean.validate(bad).count() == 0
    assert first(clean.rejected(bad))["message"] == f"Validation failed: Missing required field: {field}"
    assert clean.validate(frame(spark).drop(field)).count() == 0
    zero = frame(spark, **{field: 0 if field == "scraped_at" else ""})
    assert clean.validate(zero).count() == 0 and clean.rejected(zero).count() == 1


def test_validate_repairs(spark):
    row = first(clean.validate(frame(
        spark, "price_data struct<current:double,original:double>, stock_data struct<count:int,in_stock:boolean>, price double, original_price double",
        price_data=(1500.0, 1000.0), stock_data=(-5, True), price=2000.0, original_price=1500.0)))
    assert row["price_data"]["current"] == 1000.0 and row["stock_data"]["count"] == 0 and row["price"] == 1500.0
    assert row["corrections"] == ["price_data_above_original", "stock_count_negative", "price_above_original"]


def test_text_prices_do_not_stop_the_chain(spark):
    row = first(clean.clean_products(frame(spark, "price string, original_price string", price="abc", original_price="100"), scraped_at=1))
    assert row["price"] is None and row["original_price"] == 100.0


def test_defaults(spark):
    row = first(clean.defaults(frame(
        spark, "currency string, tags array<string>, price_data struct<current:double>, assets struct<main_image:string>,"
        "stock_data struct<in_stock:boolean>", currency="USD", tags=["a"], price_data=(1.0,), assets=("m",), stock_data=(None,)), source="s"))
    assert row["currency"] == "USD" and row["tags"] == ["a"] and row["marketing_tags"] == [] and row["attributes"] == {}
    assert row["price_data"] == {"current": 1.0, "currency": "RUB", "sale_tag": None}
    assert row["assets"] == {"main_image": "m", "gallery_images": [], "view_360": [], "video": [], "cached_images": []}
    assert row["stock_data"] == {"in_stock": False, "count": 0, "status": "unknown", "available_regions": []}
    assert (row["is_valid"], row["review_count"], row["region"], row["source"], row["scraper_notes"]) == (True, 0, "krasnodar", "s", "")


def test_clean(spark):
    row = first(clean.clean(frame(
        spark, "description string, tags array<string>, marketing_tags array<string>, attributes map<string,string>, image_urls array<string>,"
        "price double, original_price double, rating double, discount_percentage int",
        name="  Vodka   Absolut   Premium  ", description="a\r\nb\nc", tags=["Zebra", "Apple", " Middle", "Apple"],
        marketing_tags=[" ", "b", None, "", "a"], attributes={"v": "  750ml  ", "": "x", "n": None},
        image_urls=["u1", "u2", "u1"], price=-100.0, original_price=-500.0, rating=6.5, discount_percentage=150)))
    assert row["name"] == "Vodka Absolut Premium" and row["description"] == "a b c"
    assert row["tags"] == ["Apple", "Middle", "Zebra"] and row["marketing_tags"] == ["", "a", "b"]
    assert row["attributes"] == {"v": "750ml"} and row["image_urls"] == ["u1", "u2"]
    assert (row["price"], row["original_price"], row["rating"], row["discount_percentage"]) == (0.0, 0.0, None, 0)


def test_chain_on_nested_product(spark):
    schema = ("price_data struct<current:double,original:double,sale_tag:string,currency:string>,"
              "assets struct<main_image:string,gallery_images:array<string>,view_360:array<string>,video:array<string>,cached_images:array<string>>,"
              "marketing_tags array<string>")
    row = first(clean.clean_products(frame(
        spark, schema, price_data=(100.0, 200.0, None, None), assets=("m", ["a", "b", "a"], None, None, None),
        marketing_tags=["x", "y", "x"])))
    assert row["price_data"]["currency"] == "RUB" and row["assets"]["gallery_images"] == ["a", "b"]
    assert row["marketing_tags"] == ["x", "y"] and row["corrections"] == []


def test_mixed_attributes(spark):
    df = frame(spark).select("*", F.expr("""try_variant_get(parse_json('{"s":" a  b ","l":["x","",0,null,"y"],"n":5,"z":null,"o":{"k":" v "}}'),
        '$', 'map<string,variant>')""").alias("attributes"))
    assert df.schema["attributes"].dataType == VARIANTS
    got = clean.clean(df).select(F.to_json(F.to_variant_object(F.col("attributes"))).alias("a")).collect()[0]["a"]
    assert got == '{"l":["x","y"],"n":5,"o":{"k":" v "},"s":"a b"}'


def test_chain_is_one_projection(spark):
    df = clean.clean_products(frame(spark, "price double, original_price double", price=1.0, original_price=2.0), scraped_at=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_conform(spark):
    assert len(ENTITIES) == 9
    raw = spark.createDataFrame([(["", " 7 "], "1 299 ₽", "yes", "2015 г")], "product_id array<string>, price string, in_stock string, year string")
    df = conform(raw, PRODUCT)
    row = first(df)
    assert df.schema == PRODUCT.schema
    assert (row["product_id"], row["price"], row["in_stock"], row["year"], row["region"]) == ("7", 1299.0, True, "2015", None)

import math
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from vitrine.functions import text


def column(spark, values, build, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r["r"] for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def test_parse_price(spark):
    cases = {"450.00": 450.0, "450,00": 450.0, "450 руб": 450.0, "$450.00": 450.0, "  450.00  ": 450.0, "450": 450.0,
             "450 руб.": 450.0, "Цена: 1 234,50 РУБ": 1234.5, None: None, "": None, "abc": None, "1.234,50": None,
             "1 299 ₽": 1299.0, "1299.99 ₽": 1299.99, "5 000": 5000.0, ".": None, "450.": 450.0}
    assert column(spark, list(cases), text.parse_price) == list(cases.values())


@pytest.mark.parametrize("original, current, percent", [
    (1000.0, 500.0, 50), (1000.0, 750.0, 25), (1000.0, 1000.0, 0), (1000.0, 333.33, 66), (None, 500.0, None),
    (1000.0, None, None), (0.0, 500.0, None), (1000.0, 0.0, None), (-5.0, 3.0, None), (100.0, 150.0, 0)])
def test_discount(one, original, current, percent):
    assert one(text.calculate_discount, "double", original, current) == percent


def test_titles_and_numbers(spark):
    assert column(spark, ["  Vodka   Absolut\t\nPremium ", None, "", " x y\x1c"], text.clean_title) == [
        "Vodka Absolut Premium", "", "", "x y"]
    assert column(spark, ["750ml", "Year 2020 Volume 750", "none", None], text.extract_number) == [750, 2020, None, None]
    assert column(spark, ["Rating: 4.5 stars", "Price 450.50 Rating 4.5", "-3", "4.", "x"], text.extract_float) == [
        4.5, 450.5, 3.0, 4.0, None]


def test_email(spark):
    good = ["user@example.com", "a.b@mail.co.uk", "x+y@d.org", "u_1%@host-name.ru"]
    bad = ["plain", "@example.com", "user@", "user@host", "user name@example.com", "", None]
    assert column(spark, good + bad, text.is_valid_email) == [True] * len(good) + [False] * len(bad)


def test_normalize_bool(spark):
    words = ["true", "YES", " 1 ", "On", "available", "In Stock", "no", "0", "", None, "sold"]
    assert column(spark, words, text.normalize_bool) == [True] * 6 + [False] * 5
    assert column(spark, [0.0, 2.0, -1.0, None], lambda c: text.normalize_bool(c, T.DoubleType()), "double") == [
        False, True, True, False]


def test_required(spark):
    assert column(spark, ["x", " \t", None], lambda c: text.required_error(c, "name")) == [
        None, "Required field 'name' is missing", "Required field 'name' is missing"]
    with pytest.raises(Exception, match="Required field 'name' is missing"):
        column(spark, [" "], lambda c: text.require(c, "name"))


def test_urls(spark, one):
    base = "https://ex.com/a/b?x=1#f"
    hrefs = ["c", "../c", "../../../c", "/c/../d", "?q=2", "#g", "", "//h/x", "https://o/z", "mailto:a@b", "./", "..", "c/./d/",
             "x?y=../z", "a:b"]
    got = column(spark, hrefs, lambda c: text.resolve_url(F.lit(base), c))
    assert got == [urljoin(base, h) for h in hrefs]
    assert one(text.normalize_url, "string", base, "//example.com/image.jpg") == "https://example.com/image.jpg"
    assert one(text.normalize_url, "string", base, " /i.png ") == "https://ex.com/i.png"
    assert one(text.normalize_url, "string", base, "") is None
    assert column(spark, ["http://a", "http://", "a.com/x", "", None, "ftp://h/p q"], text.is_url) == [
        True, False, False, False, False, True]


def test_loader_values(spark):
    df = spark.createDataFrame([(["", None, "b"], ["1.5", "2"], ["x"], [])], "a array<string>, b array<string>, c array<string>, d array<string>")
    row = df.select(
        text.take_first(F.col("a")).alias("first"), text.float_value(F.col("b")).alias("num"),
        text.int_value(F.col("b")).alias("whole"), text.float_value(F.col("c")).alias("bad"),
        text.bool_value(F.col("d")).alias("flag"), text.first_value(F.col("d")).alias("none")).first()
    assert tuple(row) == ("b", 1.5, None, None, False, None)


def test_error_class(spark):
    df = spark.createDataFrame([("DNSLookupError", None), ("TimeoutError", 500), ("ConnectionRefusedError", None),
                                ("HttpError", 404), ("ValueError", None)], "t string, s int")
    got = [r[0] for r in df.select(text.error_class(F.col("t"), F.col("s"))).collect()]
    assert got == ["dns", "timeout", "refused", "http_404", "other"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="ab1 .,\t\n \x1f-$", max_size=12), min_size=200, max_size=200))
def test_text_functions_agree_with_python(spark, values):
    """A few hundred random texts in one job, against plain Python."""
    import re

    def price(v):
        try:
            return float(re.sub(r"[^\d.,]", "", v.strip()).replace(",", "."))
        except ValueError:
            return None

    assert column(spark, values, text.collapse) == [" ".join(v.split()) for v in values]
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    got = column(spark, values, text.parse_price)
    want = [price(v) for v in values]
    assert all((a is None) == (b is None) and (a is None or math.isclose(a, b)) for a, b in zip(got, want))

import json
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from vitrine.sources import files, tables

_S, _D = T.StringType(), T.DoubleType()
SCHEMA = (
    T.StructType().add("product_id", _S).add("name", _S).add("price", _D).add("in_stock", T.BooleanType())
    .add("image_urls", T.ArrayType(_S)).add("price_data", T.StructType().add("current", _D).add("currency", _S)))
ROWS = [("1", 'Водка "A", <b> & x', 599.99, True, ["u1", "u2"], (1.5, "RUB")), ("2", "line\nbreak", None, False, [], (None, None)),
        ("3", None, 0.0, None, ["one"], None)]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA).coalesce(1)


def back(spark, path):
    return sorted([tuple(r.asDict(True).values()) for r in files.read_products(spark, path, schema=SCHEMA).collect()], key=str)


def plain(rows):
    return sorted([tuple(dict(zip(("current", "currency"), v)) if isinstance(v, tuple) else v for v in r) for r in rows], key=str)


def test_json_lines(spark, folder):
    files.write_products(frame(spark), f"{folder}/a.jsonl")
    assert back(spark, f"{folder}/a.jsonl") == plain(ROWS)
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{folder}/a.jsonl").collect()]
    assert all(set(line) == set(SCHEMA.names) for line in lines) and "Водка" in spark.read.text(f"{folder}/a.jsonl").collect()[0]["value"]


def test_json_array_and_single_object(spark, folder):
    for name, doc in (("a.json", [{"product_id": "1"}, {"product_id": "2", "name": "n"}]), ("b.json", {"product_id": "3"})):
        with open(f"{folder}/{name}", "w") as f:
            json.dump(doc, f, indent=2)
    assert [r["product_id"] for r in files.read_products(spark, f"{folder}/a.json", schema=SCHEMA).collect()] == ["1", "2"]
    assert files.read_products(spark, f"{folder}/b.json").count() == 1
    rows = files.read_json_text(spark, folder, "json").orderBy("row_order").collect()
    assert [json.loads(r["value"])["product_id"] for r in rows] == ["1", "2", "3"]


def test_blank_lines(spark, folder):
    with open(f"{folder}/a.jsonl", "w") as f:
        f.write('{"product_id":"1"}\n\n  \n{"product_id":"2"}\n')
    assert files.read_json_text(spark, f"{folder}/a.jsonl").count() == 2
    assert files.read_products(spark, f"{folder}/a.jsonl", schema=SCHEMA).where("product_id IS NOT NULL").count() == 2


def test_csv(spark, folder):
    files.write_products(frame(spark), f"{folder}/a.csv")
    df = files.read_products(spark, f"{folder}/a.csv")
    assert df.columns == sorted(SCHEMA.names)
    rows = {r["product_id"]: r.asDict() for r in df.collect()}
    assert rows["1"]["name"] == 'Водка "A", <b> & x' and rows["2"]["name"] == "line\nbreak" and rows["3"]["name"] == ""
    assert rows["1"]["in_stock"] == "true" and rows["2"]["price"] == "" and rows["2"]["image_urls"] == "[]"
    assert json.loads(rows["1"]["price_data"]) == {"current": 1.5, "currency": "RUB"}
    files.write_products(frame(spark).limit(0), f"{folder}/empty.csv")
    parts = [p for p in os.listdir(f"{folder}/empty.csv") if p.startswith("part-")]
    assert all(open(f"{folder}/empty.csv/{p}").read().count("\n") <= 1 for p in parts)


def test_csv_on_one_line_is_split_and_reads_back(spark, folder):
    rng = random.Random(5)
    cells = ["".join(rng.choices('\\\\nr\n\r", \t#é\u0085', k=rng.randrange(12))) for _ in range(3000)] + ["", "\\", "\\\\n", " x "]
    rows = [(i, c, cells[-1 - i]) for i, c in enumerate(cells)] + [(9000, None, None)]
    df = spark.createDataFrame(rows, ["id", "b\\\nc", "a.b"]).coalesce(1)
    files.write_products(df, f"{folder}/a.csv", one_line=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = files.read_products(spark, f"{folder}/a.csv")
        assert got.select(F.spark_partition_id()).distinct().count() > 4
        assert got.columns == ["a.b", "b\\\nc", "id"]
        assert {r["id"]: (r[1], r[0]) for r in got.collect()} == {str(i): (b or "", a or "") for i, b, a in rows}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files.write_products(df.limit(0), f"{folder}/none.csv", one_line=True)
    assert files.read_products(spark, f"{folder}/none.csv").count() == 0
    files.write_products(df.select("`a.b`"), f"{folder}/one.csv", one_line=True)
    assert files.read_products(spark, f"{folder}/one.csv").count() == len(rows)


def test_xml(spark, folder):
    files.write_products(frame(spark), f"{folder}/a.xml")
    text = "\n".join(r["value"] for r in spark.read.text(f"{folder}/a.xml").collect())
    assert text.count("<product>") == 3 and "<products>" in text and text.count("<item>") == 3 and "&lt;b> &amp; x" in text
    assert "<in_stock>true</in_stock>" in text
    got = {r["product_id"]: r for r in files.read_products(spark, f"{folder}/a.xml", schema=SCHEMA).collect()}
    assert got["1"]["image_urls"] == ["u1", "u2"] and got["2"]["image_urls"] is None and got["1"]["price_data"]["current"] == 1.5
    free = files.read_products(spark, f"{folder}/a.xml").where("product_id = 1").collect()[0]
    assert free["image_urls"] == ["u1", "u2"]


def test_xml_maps_lose_nothing(spark, folder):
    df = spark.createDataFrame([("1", {"Объем (мл)": "1", "a b": "2", "A_b": "3", "n": None, "9x": "4"})], "product_id string, attributes map<string,string>")
    got = files.to_xml_layout(df).collect()[0]["attributes"]
    assert sorted(got.values()) == ["1", "2", "3", "4"] and {"объем__мл_", "a_b", "_9x"} < set(got)


@pytest.mark.parametrize("name, want", [("123invalid", "_123invalid"), ("A b", "a_b"), ("", "item"), ("x-y.z", "x-y.z"), ("-a", "_-a"), ("Цена", "цена")])
def test_element_names(spark, name, want):
    assert files.element_name(name) == want
    assert spark.range(1).select(files.element_name_of(F.lit(name)).alias("n")).collect()[0]["n"] == want


def test_formats_and_conversion(spark, folder):
    assert [files.detect_format(p) for p in ("a.json", "b.JSONL", "c.csv", "d.xml/")] == ["json", "jsonl", "csv", "xml"]
    with pytest.raises(ValueError, match="Unsupported format"):
        files.detect_format("a.parquet")
    files.write_products(frame(spark), f"{folder}/a.jsonl")
    files.convert(spark, f"{folder}/a.jsonl", f"{folder}/b.csv", ["product_id", "price"], schema=SCHEMA)
    assert files.read_products(spark, f"{folder}/b.csv").columns == ["price", "product_id"]


def test_table(spark, folder):
    name = "products_under_test"
    tables.append_products(frame(spark), name, path=f"{folder}/t")
    tables.append_products(frame(spark).select("name", "product_id"), name)
    stored = spark.table(name)
    assert stored.count() == 6 and stored.select("id").distinct().count() == 6
    assert dict(stored.dtypes)["image_urls"] == "string" and stored.where("price_data IS NULL").count() == 4
    stats = tables.table_statistics(spark, name).collect()[0]
    assert stats["total_items"] == 6 and stats["latest_item"] == stored.agg(F.max("created_at")).collect()[0][0]
    tables.export_json(spark, f"{folder}/e.json", name)
    ids = [json.loads(r["value"])["id"] for r in spark.read.text(f"{folder}/e.json").collect()]
    assert sorted(ids) == sorted(r["id"] for r in stored.collect())
    assert name in tables.catalog_statistics(spark, name).collect()[0]["tables"]
    assert tables.query(spark, f"SELECT name FROM {name} WHERE price > ?", [500]).count() == 1
    with pytest.raises(ValueError, match="not in the table"):
        tables.append_products(frame(spark).withColumn("new", F.lit(1)), name)
    with pytest.raises(Exception):
        tables.query(spark, "SELECT nothing FROM nowhere")
    spark.sql(f"DROP TABLE {name}")


def test_categories(spark, folder):
    with open(f"{folder}/categories.json", "w") as f:
        json.dump([{"id": "1", "name": "Вино", "url": "https://e/vino/"}], f)
    assert tuple(tables.load_categories(spark, f"{folder}/categories.json").collect()[0]) == ("1", "Вино", "https://e/vino/")
    urls = spark.createDataFrame([("https://e.com/category/konyak/",)], "url string")
    assert tables.categories_from_urls(urls).collect()[0]["name"] == "Konyak"


def test_json_is_read_by_its_content(spark, folder):
    rows = [{"product_id": str(i), "name": "n", "price": 1.5} for i in range(1000)]
    df = spark.createDataFrame(rows, "product_id string, name string, price double").repartition(4)
    files.write_products(df, f"{folder}/own.json")
    own = files.read_products(spark, f"{folder}/own.json", schema="product_id string, name string, price double")
    assert own.count() == own.select("product_id").distinct().count() == 1000
    assert files.read_json_text(spark, f"{folder}/own.json").count() == 1000
    files.convert(spark, f"{folder}/own.json", f"{folder}/own.csv")
    assert files.read_products(spark, f"{folder}/own.csv").count() == 1000
    os.makedirs(f"{folder}/mixed.json")
    for name, content in {
        "array": json.dumps(rows[:3], indent=2), "one": json.dumps(rows[3], indent=2), "flat": json.dumps(rows[4]), "empty": "",
        "lines": "\n\n" + "\n".join(map(json.dumps, rows[5:9])),
    }.items():
        with open(f"{folder}/mixed.json/{name}.json", "w") as out:
            out.write(content)
    mixed = files.read_products(spark, f"{folder}/mixed.json", schema="product_id string, price double")
    assert sorted(r["product_id"] for r in mixed.collect()) == [str(i) for i in range(9)]
    assert files.read_json_text(spark, f"{folder}/mixed.json").count() == 9


def test_what_does_not_fit_is_told(spark, folder):
    with open(f"{folder}/a.jsonl", "w") as out:
        out.write('{"product_id": "1"}\n{"product_id": \n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_products(spark, f"{folder}/a.jsonl", schema="product_id string").collect()
    kept = files.read_products(spark, f"{folder}/a.jsonl", schema="product_id string", corrupt="bad").collect()
    assert [(r["product_id"], r["bad"]) for r in kept] == [("1", None), (None, '{"product_id": ')]
    with open(f"{folder}/a.xml", "w") as out:
        out.write("<products><product><name>a</name><price>abc</price></product></products>")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_products(spark, f"{folder}/a.xml", schema="name string, price double").collect()
    with open(f"{folder}/cut.json", "w") as out:
        out.write('[{"a": 1},\n {"a"')
    with pytest.raises(Exception, match="not one JSON document"):
        files.read_json_text(spark, f"{folder}/cut.json").collect()


LINES = [json.dumps({"a": i}) for i in range(1, 1000)]


@pytest.mark.parametrize("first,fits", [('{"a":0},', True), ('[{"a":0}]', True), ("[", False), ('{"a":', False)])
def test_a_broken_first_line_loses_no_other(spark, folder, first, fits):
    with open(f"{folder}/a.json", "w") as out:
        out.write("\n".join([first, *LINES]))
    kept = files.read_products(spark, f"{folder}/a.json", schema="a int", corrupt="bad").collect()
    assert sorted(r["a"] for r in kept if r["bad"] is None and r["a"]) == list(range(1, 1000))
    assert len(kept) == 1000 and (fits or [r["bad"] for r in kept if r["bad"]] == [first])
    assert files.read_json_text(spark, f"{folder}/a.json").count() == 1000
    if not fits:
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|not JSON lines"):
            files.read_products(spark, f"{folder}/a.json", schema="a int").collect()


@pytest.mark.parametrize("text", [
    '[{"a":1}]\n[{"a":2}]', '{\n"a":1\n}\n{\n"a":2\n}', '[\n{"a":1}\n] rest', '[\n{"a":1},', '{"a":1}] 1', '{"a":1}{"a":2}',
    '{"a":1}\n{"a":2}{"a":3}'])
def test_a_file_that_is_not_one_document_is_not_read_in_part(spark, folder, text):
    with open(f"{folder}/a.json", "w") as out:
        out.write(text)
    with pytest.raises(ValueError, match="a.json"):
        files.read_products(spark, f"{folder}/a.json", schema="a int")
    with pytest.raises(Exception, match="not one JSON document"):
        files.read_json_text(spark, f"{folder}/a.json").collect()
    whole = files.read_products(spark, f"{folder}/a.json", schema="a int", corrupt="bad").collect()
    assert [(r["a"], r["bad"]) for r in whole] == [(None, text)]


@pytest.mark.parametrize("text,rows", [
    ('[\n{"a":1}\n,\n{"a":2}\n]', 2), ('{"a":\n1}', 1), ('{"a":1,"b":\n{"c":"} {"}}', 1), ('{"a":1,"b":"} {"}\n{"a":2}', 2), ("[]", 0)])
def test_documents_are_told_from_lines(spark, folder, text, rows):
    with open(f"{folder}/a.json", "w") as out:
        out.write(text)
    assert files.read_products(spark, f"{folder}/a.json", schema="a int").count() == rows

"""Reading and writing products as JSON, JSON Lines, CSV and XML, and run statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from vitrine.functions.jsontext import parsed_json

FORMATS = {"json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "csv": "csv", "xml": "xml"}
ROOT_TAG, ROW_TAG, ITEM_TAG = "products", "product", "item"
#: Last column of a CSV file whose records are one line each; no escaped name looks like it.
ONE_LINE = "\\one line"
_WRITTEN = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))


def detect_format(path: str) -> str:
    """Format by the last extension of the path."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in FORMATS:
        raise ValueError(f"Unsupported format: {suffix}")
    return FORMATS[suffix]


def read_products(
    spark: SparkSession, path: str, fmt: str = "auto", schema: T.StructType | str | None = None, multi_line: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """Rows of a product file or folder.

    ``json`` is an array (or one object) per file, or one object per line as
    this library writes it: the lines of each file tell (see
    :func:`json_layouts`).  ``jsonl`` is one object per line, ``csv`` has a header and gives text only, ``xml`` has one ``product``
    element per row.  Give a schema where it is known: without one Spark reads
    the input twice.  CSV cells may hold line breaks, which makes a file one
    task; with ``multi_line=False`` large CSV files without them are split, and
    so are those written with ``one_line=True``, which their header tells.
    An array file is one task too, since it cannot be split.

    JSON and XML that do not fit the schema raise an error; with ``corrupt``
    such a row stays and its text lands in the column of that name.  A file that
    is neither lines nor one whole document is not read in part: it raises, or
    is one row with its whole text in that column.
    """
    fmt = detect_format(path) if fmt == "auto" else fmt
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if corrupt is not None and schema is not None and corrupt not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])

    def reader(form: T.StructType | None = schema) -> DataFrameReader:
        bad = {"mode": "FAILFAST"} if corrupt is None else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
        return (spark.read if form is None else spark.read.schema(form)).options(**bad)

    if fmt == "json":
        lines, documents, broken = json_layouts(spark, path)
        if broken and corrupt is None:
            raise ValueError(f"not JSON lines and not one JSON document: {', '.join(sorted(broken))}")
        if not documents and not broken:
            return reader().json(path)
        if not lines and not broken:
            return reader().option("multiLine", True).json(path)
        # folders named like column=value below a folder of several files stay columns
        several = len(lines) + len(documents) + len(broken) > 1 and not any(c in path for c in "*?[{")
        base = {"basePath": path} if several else {}
        parts = [reader().options(**base).json(lines)] if lines else []
        if documents:
            parts.append(reader().options(**base).option("multiLine", True).json(documents))
        if broken:
            text = spark.read.options(**base).text(broken, wholetext=True).withColumnRenamed("value", corrupt)
            rest = [] if schema is None else [
                F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in text.columns]
            parts.append(text.select("*", *rest))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if fmt == "jsonl":
        return reader().json(path)
    if fmt == "csv":
        split = spark.read.options(header=True, escape='"').csv(path)  # reads the header alone
        if split.columns[-1:] == [ONE_LINE]:
            return split.select(*[
                _broken_again(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(_name_broken_again(c)) for c in split.columns[:-1]])
        rows = spark.read.options(header=True, multiLine=True, escape='"').csv(path) if multi_line else split
        return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns])
    if fmt == "xml":
        layout = None if schema is None else _with_items(schema)
        return _from_items(reader(layout).option("rowTag", ROW_TAG).format("xml").load(path))
    raise ValueError(f"Unsupported format: {fmt}")


def one_json_value(text: Column) -> Column:
    """Whether a text is exactly one JSON value, with nothing before or after it.

    JSON readers stop behind the first value and do not tell what they leave.
    Inside an array the value has to be followed by the elements put behind it:
    a text that ends its own array early has the same number of elements
    however many follow, and one with two values is no array or has one too many.
    """
    held = [F.json_array_length(F.concat(F.lit("["), text, F.lit(behind))) for behind in (",1]", ",1,1]")]
    return F.coalesce((held[0] == 2) & (held[1] == 3), F.lit(False))


def json_layouts(spark: SparkSession, path: str) -> tuple[list[str], list[str], list[str]]:
    """Files below a path that hold one object per line, one document, or neither.

    A file is of lines when at least half of its lines that are not blank are
    whole objects.  Objects of a document have commas between them, so a document
    of several lines never has as many.  Lines that are broken then are for the reader to tell.  A file that
    holds no such lines is a document if all of it is one JSON value; such a
    file has at most 2 GiB.

    One pass over the text, combined on the map side, and one more over the
    files that are not of lines; the driver holds the file names, which it lists
    for any read.  ``fmt="jsonl"`` does without.
    """
    line = F.trim("value")
    count = lambda mark: F.length(line) - F.length(F.replace(line, F.lit(mark), F.lit("")))
    whole = line.startswith("{") & line.endswith("}") & (count("{") == count("}"))
    # two values side by side, which only the text of a string may look like
    double = line.rlike(r"[}\]]\s*[\[{]")
    files = spark.read.text(path).where(line != "").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(whole).alias("whole"),
        F.count_if(whole & F.when(double, ~one_json_value(line)).otherwise(False)).alias("double")).collect()
    lines = [r["file"] for r in files if 2 * r["whole"] >= r["lines"] and not r["double"]]
    doubled = [r["file"] for r in files if 2 * r["whole"] >= r["lines"] and r["double"]]
    others = [r["file"] for r in files if 2 * r["whole"] < r["lines"]]
    if not others:
        return lines, [], doubled
    read = spark.read.text(others, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), one_json_value(F.col("value")).alias("is_one")).collect()
    return (lines, [r["file"] for r in read if r["is_one"]], doubled + [r["file"] for r in read if not r["is_one"]])


def write_products(
    df: DataFrame, path: str, fmt: str = "auto", mode: str = "errorifexists", one_line: bool = False
) -> None:
    """Write in one of the formats; every task writes its own part.

    With ``one_line`` no record of a CSV file spans lines: line breaks in cells
    and names are written as ``\\n`` and ``\\r`` and a backslash as two, and an
    empty last column named ``ONE_LINE`` says so.  :func:`read_products` then
    splits the file and gives the cells as they were.
    """
    fmt = detect_format(path) if fmt == "auto" else fmt
    if fmt in ("json", "jsonl"):
        df.write.mode(mode).option("ignoreNullFields", False).json(path)
    elif fmt == "csv":
        flat = flatten_rows(df)
        if one_line:
            flat.select(
                *[_on_one_line(F.col(f"`{c}`")).alias(_name_on_one_line(c)) for c in sorted(flat.columns)], F.lit("").alias(ONE_LINE),
            ).write.mode(mode).options(
                header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
            return
        flat.select(*[F.col(f"`{c}`") for c in sorted(flat.columns)]).write.mode(mode).options(
            header=True, escape='"', emptyValue="").csv(path)
    elif fmt == "xml":
        to_xml_layout(df).write.mode(mode).options(rootTag=ROOT_TAG, rowTag=ROW_TAG).format("xml").save(path)
    else:
        raise ValueError(f"Unsupported format: {fmt}")


def convert(
    spark: SparkSession, source: str, target: str, columns: list[str] | None = None,
    schema: T.StructType | None = None, mode: str = "errorifexists",
) -> None:
    """Read one format and write another, with a choice of columns."""
    df = read_products(spark, source, schema=schema)
    write_products(df.select(*columns) if columns else df, target, mode=mode)


# ---------------------------------------------------------------------------
# CSV cells
# ---------------------------------------------------------------------------


def flatten_value(c: Column, dtype: T.DataType) -> Column:
    """Null -> empty, nested -> JSON text, truth -> ``true``/``false``, else text."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        cell = F.to_json(c, {"ignoreNullFields": "false"})
    else:
        cell = c.cast("string")
    return F.coalesce(cell, F.lit(""))


def _on_one_line(cell: Column) -> Column:
    for plain, written in _WRITTEN:
        cell = F.replace(cell, F.lit(plain), F.lit(written))
    return cell


def _broken_again(cell: Column) -> Column:
    """The way back.  A pair of backslashes, found from the left, is one, and what lies between holds none but escapes."""
    between = F.transform(F.split(cell, r"\\\\"), lambda p: F.replace(
        F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(cell, F.lit("\\")), F.array_join(between, "\\")).otherwise(cell)


def _name_on_one_line(name: str) -> str:
    for plain, written in _WRITTEN:
        name = name.replace(plain, written)
    return name


def _name_broken_again(name: str) -> str:
    return "\\".join(p.replace("\\n", "\n").replace("\\r", "\r") for p in name.split("\\\\"))


def flatten_rows(df: DataFrame) -> DataFrame:
    return df.select(*[flatten_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# XML layout
# ---------------------------------------------------------------------------


def element_name(name: str) -> str:
    """Column name as an element name."""
    clean = "".join(ch if ch.isalnum() or ch in "_-." else "_" for ch in name.lower())
    if clean and not (clean[0].isalpha() or clean[0] == "_"):
        clean = "_" + clean
    return clean or ITEM_TAG


def element_name_of(c: Column) -> Column:
    """The same rule for map keys."""
    clean = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_.-]", "_")
    clean = F.when(clean.rlike(r"^[^\p{L}_]"), F.concat(F.lit("_"), clean)).otherwise(clean)
    return F.when(clean == "", F.lit(ITEM_TAG)).otherwise(clean)


def _xml_value(c: Column, dtype: T.DataType) -> Column:
    """Lists become a container of ``item`` elements; an empty list is left out."""
    if isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda v: _xml_value(v, dtype.elementType)) if _nested(dtype.elementType) else c
        return F.when(F.size(c) > 0, F.struct(items.alias(ITEM_TAG)))
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[
            _xml_value(c[f.name], f.dataType).alias(element_name(f.name)) for f in dtype.fields]))
    if isinstance(dtype, T.MapType):
        value = lambda v: _xml_value(v, dtype.valueType) if _nested(dtype.valueType) else v
        named = F.transform(F.map_entries(c), lambda e: F.struct(
            element_name_of(e["key"].cast("string")).alias("key"), value(e["value"]).alias("value")))
        return _unique_keys(F.filter(named, lambda e: e["value"].isNotNull()))
    if isinstance(dtype, T.VariantType):
        return F.coalesce(F.try_variant_get(c, "$", "string"), F.to_json(c))
    return c


def _unique_keys(entries: Column) -> Column:
    """A map; keys that became equal get a number, so no value is lost."""
    keys = F.transform(entries, lambda e: e["key"])
    numbered = F.transform(entries, lambda e, i: F.struct(
        F.when(
            F.array_position(keys, e["key"]) == i + 1, e["key"]
        ).otherwise(F.concat(e["key"], F.lit("_"), (i + 1).cast("string"))).alias("key"),
        e["value"].alias("value")))
    return F.when(entries.isNotNull(), F.map_from_entries(numbered))


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.StructType, T.MapType, T.VariantType))


def to_xml_layout(df: DataFrame) -> DataFrame:
    return df.select(*[
        _xml_value(F.col(f"`{f.name}`"), f.dataType).alias(element_name(f.name)) for f in df.schema.fields])


def _with_items(dtype: T.DataType) -> T.DataType:
    """Schema of the XML layout for a schema of the table."""
    if isinstance(dtype, T.ArrayType):
        return T.StructType([T.StructField(ITEM_TAG, T.ArrayType(_with_items(dtype.elementType)))])
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _with_items(f.dataType)) for f in dtype.fields])
    return dtype


def _is_container(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and dtype.names == [ITEM_TAG]


def _from_items(df: DataFrame) -> DataFrame:
    """Undo the ``item`` containers at the top level and inside structs."""
    def undo(c: Column, dtype: T.DataType) -> Column:
        if _is_container(dtype):
            inner = c[ITEM_TAG]
            if isinstance(dtype[ITEM_TAG].dataType, T.ArrayType):
                return inner
            return F.when(inner.isNotNull(), F.array(inner))
        if isinstance(dtype, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[undo(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
        return c

    return df.select(*[undo(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Run statistics
# ---------------------------------------------------------------------------


def write_run_stats(summary: DataFrame, folder: str) -> None:
    """Append run summaries as JSON and as CSV; many runs share the two folders."""
    kept = summary.persist()
    try:
        kept.write.mode("append").option("ignoreNullFields", False).json(f"{folder}/json")
        kept.write.mode("append").option("header", True).csv(f"{folder}/csv")
    finally:
        kept.unpersist()


def read_run_stats(spark: SparkSession, folder: str, schema: T.StructType, *metrics: str) -> DataFrame:
    """Chosen figures of all saved runs."""
    return spark.read.schema(schema).json(f"{folder}/json").select(*metrics)


# ---------------------------------------------------------------------------
# Raw rows with their place in the input
# ---------------------------------------------------------------------------


def read_json_text(spark: SparkSession, path: str | list[str], fmt: str = "auto") -> DataFrame:
    """JSON rows as text: ``value`` plus ``row_order``, which follows the files.

    Each object of an array file becomes a row of its own.  ``row_order`` sorts
    by file, block and place in the block, so it needs no global numbering.
    A file that is neither lines nor one whole document, or a document larger
    than a variant can be, raises an error; lines are not parsed here.
    """
    fmt = detect_format(path) if fmt == "auto" else fmt
    if fmt == "jsonl":
        lines = spark.read.text(path).where("trim(value) <> ''")
        return lines.select("value", F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line")).alias("row_order"))
    if fmt == "json":
        lines, documents, broken = json_layouts(spark, path)
        if lines:
            of_lines = read_json_text(spark, lines, "jsonl")
            others = documents + broken
            return of_lines.unionByName(read_json_text(spark, others, "document")) if others else of_lines
    if fmt in ("json", "document"):
        whole = spark.read.text(path, wholetext=True)
        document = F.expr(parsed_json("value"))
        unread = F.concat(F.lit("not one JSON document of at most 128 MiB: "), F.col("_metadata.file_path"))
        lost = (document.isNull() | ~one_json_value(F.col("value"))) & (F.trim("value") != "")
        rows = F.when(lost, F.raise_error(unread)).otherwise(F.coalesce(
            F.try_variant_get(document, "$", "array<variant>"), F.array(document)))
        return whole.select(
            F.col("_metadata.file_path").alias("file"), F.posexplode(rows).alias("line", "row")
        ).select(F.to_json("row").alias("value"), F.struct(
            "file", F.lit(0).cast("bigint").alias("block"), F.col("line").cast("bigint").alias("line")).alias("row_order"))
    raise ValueError(f"Unsupported format: {fmt}")

"""Completeness, type and consistency reports.

Table-wide figures come from one aggregate each: as many counters as there are
fields, combined on the map side, and turned into rows only afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vitrine.functions.jsontext import parsed_json
from vitrine.functions.text import is_url, settled
from vitrine.functions.nodes import let
from vitrine.functions.truth import is_filled, variant_filled_sql
from vitrine.sources.scratch import cut_lineage

# Fixed values of the output check.
REQUIRED = ("product_id", "name", "product_url", "scraped_at")
KEY_FIELDS = ("product_id", "name")
NUMBER_FIELDS = {
    "price": "float or int", "original_price": "float or int", "rating": "float or int",
    "review_count": "int", "stock_quantity": "int", "discount_percentage": "int", "scraped_at": "int",
}
URL_FIELDS = ("product_url", "image_url")
LIST_FIELDS = ("marketing_tags", "image_urls")


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _filled(have: dict[str, T.DataType], name: str) -> Column:
    return is_filled(F.col(f"`{name}`"), have[name]) if name in have else F.lit(False)


def _stacked(row: DataFrame, entries: list[list[str]], names: str) -> DataFrame:
    """Turn a one-row aggregate into one row per entry."""
    body = ", ".join(", ".join(e) for e in entries)
    return row.select(F.expr(f"stack({len(entries)}, {body}) AS ({names})"))


def completeness(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Per required field: filled rows, all rows, whether complete, and a message."""
    have = _types(df)
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(_filled(have, c)).alias(f"f{i}") for i, c in enumerate(required)])
    rows = _stacked(counts, [[f"'{c}'", f"f{i}", "n"] for i, c in enumerate(required)], "field, filled, total")
    missing = F.col("total") - F.col("filled")
    return rows.select(
        "field", "filled", "total", (missing == 0).alias("found"),
        F.when(missing > 0, F.format_string("Field '%s' missing in %d items", F.col("field"), missing)).alias("message"),
    )


def validity(df: DataFrame, keys=KEY_FIELDS, required=()) -> DataFrame:
    """One row: total, valid and invalid rows, and the missing values of required fields."""
    have = _types(df)
    valid = reduce(lambda a, b: a & b, [_filled(have, k) for k in keys])
    errors = [F.count_if(~_filled(have, c)) for c in required]
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        (reduce(lambda a, b: a + b, errors) if errors else F.lit(0).cast("bigint")).alias("errors"),
    )


def type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.NumericType):
        return "float"
    if isinstance(dtype, T.ArrayType):
        return "array"
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "object"
    return "string"


def field_stats(df: DataFrame) -> DataFrame:
    """Per column: filled and non-null rows, share filled, type; sorted by name."""
    have = _types(df)
    names = sorted(have)
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[
        c for i, name in enumerate(names) for c in (
            F.count_if(_filled(have, name)).alias(f"f{i}"),
            F.count(F.col(f"`{name}`")).alias(f"v{i}"),
        )])
    rows = _stacked(
        counts, [[f"'{name}'", f"f{i}", f"v{i}", "n", f"'{type_name(have[name])}'"] for i, name in enumerate(names)],
        "field, filled, non_null, total, declared")
    return rows.select(
        "field", "filled", "non_null", "total",
        F.when(F.col("total") > 0, F.col("filled") / F.col("total") * 100).otherwise(F.lit(0.0)).alias("percentage"),
        F.when(F.col("non_null") > 0, F.col("declared")).otherwise(F.lit("null")).alias("type"),
    ).orderBy("field")


# Type name of a variant from its schema text; null when there is no value.
_KIND = (
    "CASE WHEN {s} = 'STRING' THEN 'string' WHEN {s} = 'BOOLEAN' THEN 'boolean'"
    " WHEN {s} = 'BIGINT' OR {s} RLIKE '^DECIMAL.[0-9]+,0.$' THEN 'integer'"
    " WHEN {s} RLIKE '^(DECIMAL|DOUBLE|FLOAT)' THEN 'float' WHEN {s} LIKE 'ARRAY%' THEN 'array'"
    " WHEN {s} LIKE 'OBJECT%' THEN 'object' WHEN {s} IS NULL OR {s} = 'VOID' THEN 'null' ELSE 'string' END"
)


def json_kind(v: str) -> str:
    """SQL: type name of a variant value."""
    return let(f"schema_of_variant({v})", lambda s: _KIND.format(s=s))


def json_field_stats(raw: DataFrame, order: Column, text: str = "value") -> DataFrame:
    """The same statistics for JSON text, over every key that any row has.

    ``order`` tells which row comes first; the type is that of the first value
    that is not null.  Each text is parsed once, in one aggregate: a row that is
    JSON also counts under no field, which gives the total.  Rows that are no
    JSON are left out.
    """
    parsed = raw.select(order.alias("at"), F.expr(parsed_json(f"`{text}`")).alias("doc"))
    row = "named_struct('key', CAST(NULL AS STRING), 'value', CAST(NULL AS VARIANT))"
    fields = "coalesce(map_entries(try_variant_get(doc, '$', 'map<string,variant>')), array())"
    entries = parsed.select("at", F.explode_outer(F.expr(
        f"CASE WHEN doc IS NOT NULL THEN concat(array({row}), {fields}) END")).alias("entry")).where("entry IS NOT NULL")
    stats = entries.select("at", F.col("entry.key").alias("field"), F.col("entry.value").alias("v")).select(
        "at", "field", F.expr(json_kind("v")).alias("kind"), F.expr(variant_filled_sql("v")).alias("is_filled")
    ).groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_filled").alias("filled"),
        F.count_if(F.col("kind") != "null").alias("non_null"),
        F.min_by("kind", F.when(F.col("kind") != "null", F.col("at"))).alias("first_kind"),
    )
    # one row for each field
    total = F.max(F.when(F.col("field").isNull(), F.col("rows"))).over(Window.partitionBy())
    return stats.withColumn("total", total).where("field IS NOT NULL").select(
        "field", "filled", "non_null", "total", (F.col("filled") / F.col("total") * 100).alias("percentage"),
        F.coalesce("first_kind", F.lit("null")).alias("type"),
    ).orderBy("field")


def recommendations(validity_row: DataFrame, stats: DataFrame) -> DataFrame:
    """What to do about the figures; one line per finding.  The texts are fixed values."""
    share = F.col("invalid") / F.col("total") * 100
    invalid = validity_row.where((F.col("total") > 0) & (share > 10)).select(
        F.lit(1).alias("rank"), F.lit("").alias("field"),
        F.format_string(
            "High number of invalid items (%.1f%%). Check spider selectors and data extraction logic.", share,
        ).alias("recommendation"))
    sparse = stats.where(F.col("percentage") < 50).select(
        F.lit(2).alias("rank"), "field",
        F.format_string(
            "Field '%s' has only %.1f%% filled. Consider updating selectors or adding fallback extraction methods.",
            F.col("field"), F.col("percentage")).alias("recommendation"))
    good = validity_row.where(F.col("errors") == 0).select(
        F.lit(3).alias("rank"), F.lit("").alias("field"),
        F.lit("✅ All validations passed! Data looks good.").alias("recommendation"))
    return invalid.unionByName(sparse).unionByName(good).orderBy("rank", "field").select("recommendation")


# ---------------------------------------------------------------------------
# Output check: raw JSON rows, because the types matter
# ---------------------------------------------------------------------------


def _value(name: str) -> str:
    return f"try_variant_get(doc, '$.{name}', 'variant')"


def _python_name(kind: Column) -> Column:
    names = {"boolean": "bool", "integer": "int", "array": "list", "object": "dict", "string": "str"}
    out = F.when(kind == "float", F.lit("float"))
    for k, n in names.items():
        out = out.when(kind == k, F.lit(n))
    return out.otherwise(kind)


def check_output(raw: DataFrame, index: Column, text: str = "value") -> DataFrame:
    """``errors`` and ``warnings`` of each JSON row; ``index`` numbers the rows.

    All findings of a row are built in one projection, with no shuffle.  A text
    that is no JSON has that one error; of a repeated key the last value counts.
    """
    picked = raw.select("*", index.alias("row_index"), F.expr(parsed_json(f"`{text}`")).alias("doc"))
    fields = [*dict.fromkeys([*REQUIRED, *NUMBER_FIELDS, *URL_FIELDS, *LIST_FIELDS])]
    picked = picked.select("*", *[F.expr(_value(f)).alias(f"v_{f}") for f in fields])
    picked = picked.select("*", *[F.expr(f"schema_of_variant(v_{f})").alias(f"s_{f}") for f in fields])
    picked = picked.select("*", *[F.expr(_KIND.format(s=f"s_{f}")).alias(f"k_{f}") for f in fields],
                           *[F.expr(variant_filled_sql(f"v_{f}")).alias(f"f_{f}") for f in fields])
    at = F.concat(F.lit("Product "), F.col("row_index").cast("string"), F.lit(": "))
    shown = lambda f: F.expr(f"coalesce(try_variant_get(v_{f}, '$', 'string'), to_json(v_{f}))")
    number = lambda f: F.expr(f"try_variant_get(v_{f}, '$', 'double')")

    errors = [
        F.when(~F.col(f"f_{f}"), F.concat(at, F.lit(f"Missing required field '{f}'"))) for f in REQUIRED]
    warnings = []
    for f, expected in NUMBER_FIELDS.items():
        kind = F.col(f"k_{f}")
        right = ("integer", "boolean", "float") if "float" in expected else ("integer", "boolean")
        warnings.append(F.when((kind != "null") & ~kind.isin(*right), F.concat(
            at, F.lit(f"Field '{f}' has type "), _python_name(kind), F.lit(f", expected {expected}"))))
        if "float" in expected and f != "rating":
            warnings.append(F.when(kind.isin("integer", "float") & (number(f) < 0), F.concat(
                at, F.lit(f"Field '{f}' is negative: "), shown(f))))
    for f in URL_FIELDS:
        warnings.append(F.when(F.col(f"f_{f}") & ~is_url(shown(f)), F.concat(
            at, F.lit(f"Field '{f}' has invalid URL: "), shown(f))))
    price, original = number("price"), number("original_price")
    warnings.append(F.when(F.col("f_price") & F.col("f_original_price") & (price > original), F.concat(
        at, F.lit("Price ("), price.cast("string"), F.lit(") > original_price ("), original.cast("string"), F.lit(")"))))
    for f in LIST_FIELDS:
        warnings.append(F.when(F.col(f"f_{f}") & (F.col(f"k_{f}") != "array"), F.concat(
            at, F.lit(f"'{f}' should be a list"))))
    unread = F.array(F.concat(at, F.lit("Not valid JSON")))
    return picked.select(
        *raw.columns, "row_index",
        settled(F.when(F.col("doc").isNull(), unread).otherwise(F.array_compact(F.array(*errors)))).alias("errors"),
        F.array_compact(F.array(*warnings)).alias("warnings"),
    )


def output_totals(checked: DataFrame) -> DataFrame:
    """One row of totals; an empty input is an error of its own."""
    bad = F.size("errors") > 0
    row = checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("invalid"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("errors"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("warnings"),
    )
    return row.withColumn("message", F.when(F.col("total") == 0, F.lit("No products to validate")))


def findings(checked: DataFrame, kind: str) -> DataFrame:
    """One row per message of the ``errors`` or ``warnings`` column."""
    # Outer, so that no test for emptiness is pushed down and evaluated a second time.
    rows = checked.select("row_index", F.posexplode_outer(kind).alias("position", "message"))
    return rows.where("position IS NOT NULL")


def report_lines(checked: DataFrame, kind: str, shown: int = 10) -> DataFrame:
    """The first messages and a closing line with the number of further ones.

    The rows that have messages are written first, so that the check runs once.
    """
    checked = cut_lineage(checked.select("row_index", kind).where(F.size(kind) > 0))
    rows = findings(checked, kind)
    first = rows.orderBy("row_index", "position").limit(shown).select("row_index", "position", "message")
    more = checked.agg((F.coalesce(F.sum(F.size(kind)), F.lit(0)) - shown).alias("more")).where("more > 0").select(
        F.lit(None).cast("bigint").alias("row_index"), F.lit(None).cast("int").alias("position"),
        F.format_string(f"... and %d more {kind}", F.col("more")).alias("message"))
    return first.unionByName(more).orderBy(F.col("row_index").asc_nulls_last(), "position")


def sample_row(df: DataFrame, order: Column) -> DataFrame:
    """The first row in the given order."""
    return df.orderBy(order).limit(1)

"""The cleaning chain: validate, fill defaults, normalise.

Every stage is ``DataFrame -> DataFrame`` and a single ``select``, so the chain
is one projection after Catalyst is done with it, needs no shuffle, and runs the
same on batch and streaming input.  Columns a table does not have are left
alone, except where a default is due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitrine.functions.text import collapse, strip
from vitrine.functions.truth import is_filled
from vitrine.schemas import ASSETS, STOCK

# Fixed values.
REQUIRED = ("product_id", "name", "product_url", "scraped_at")
TEXT_FIELDS = ("name", "brand", "description", "tasting_notes", "food_pairing", "category")
CURRENCY = "RUB"
REGION = "krasnodar"
UNKNOWN = "unknown"

REASONS = "reasons"
CORRECTIONS = "corrections"
CORRECTION_KINDS = (
    "price_data_above_original", "stock_count_negative", "price_above_original",
    "price_negative", "original_price_negative", "rating_out_of_range", "discount_out_of_range",
)

_TEXTS = T.ArrayType(T.StringType())


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _replace(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """One select: changed columns in place, new ones at the end."""
    kept = [changes[c].alias(c) if c in changes else F.col(f"`{c}`") for c in df.columns]
    return df.select(*kept, *[c.alias(n) for n, c in changes.items() if n not in df.columns])


def _column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _number(c: Column, dtype: T.DataType) -> Column:
    return c if isinstance(dtype, T.NumericType) else c.try_cast("double")


def _with_fields(name: str, dtype: T.StructType, changes: dict[str, Column]) -> Column:
    """The struct column with some fields changed, order and types kept."""
    full = F.struct(*[
        changes.get(f.name, F.col(name)[f.name]).cast(f.dataType).alias(f.name) for f in dtype.fields
    ])
    return F.when(F.col(name).isNotNull(), full)


# ---------------------------------------------------------------------------
# Stage one: validate
# ---------------------------------------------------------------------------


def _with_reasons(df: DataFrame, required=REQUIRED) -> DataFrame:
    have = _types(df)
    missing = [
        F.when(~is_filled(F.col(c), have[c]), F.lit(f"Missing required field: {c}"))
        if c in have else F.lit(f"Missing required field: {c}")
        for c in required
    ]
    return df.withColumn(REASONS, F.array_compact(F.array(*missing)))


def rejected(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Rows that lack a required field, with ``reasons`` and one message."""
    bad = _with_reasons(df, required).where(F.size(REASONS) > 0)
    return bad.withColumn("message", F.concat(F.lit("Validation failed: "), F.array_join(REASONS, "; ")))


def _accepted(df: DataFrame, required=REQUIRED) -> DataFrame:
    have = _types(df)
    test = F.lit(True)
    for c in required:
        test = test & (is_filled(F.col(c), have[c]) if c in have else F.lit(False))
    return df.where(test)


def validate(df: DataFrame, required=REQUIRED) -> DataFrame:
    """Keep rows with all required fields; repair contradictory prices and stock."""
    df = _accepted(df, required)
    have = _types(df)
    changes, notes = {}, []

    price = have.get("price_data")
    if isinstance(price, T.StructType) and {"current", "original"} <= set(price.names):
        current = _number(F.col("price_data.current"), price["current"].dataType)
        original = _number(F.col("price_data.original"), price["original"].dataType)
        wrong = (current != 0) & (original != 0) & (current > original)
        capped = F.when(wrong, F.col("price_data.original")).otherwise(F.col("price_data.current"))
        changes["price_data"] = _with_fields("price_data", price, {"current": capped})
        notes.append((wrong, "price_data_above_original"))

    stock = have.get("stock_data")
    if isinstance(stock, T.StructType) and "count" in stock.names and isinstance(stock["count"].dataType, T.NumericType):
        wrong = F.col("stock_data.count") < 0
        fixed = F.when(wrong, F.lit(0)).otherwise(F.col("stock_data.count"))
        changes["stock_data"] = _with_fields("stock_data", stock, {"count": fixed})
        notes.append((wrong, "stock_count_negative"))

    if "price" in have and "original_price" in have:
        now = _number(F.col("price"), have["price"])
        before = _number(F.col("original_price"), have["original_price"])
        wrong = now > before
        changes["price"] = F.when(wrong, before).otherwise(now)
        changes["original_price"] = before
        notes.append((wrong, "price_above_original"))

    changes[CORRECTIONS] = _noted(df, notes)
    return _replace(df, changes)


def _noted(df: DataFrame, notes: list[tuple[Column, str]]) -> Column:
    new = [F.when(test, F.lit(name)) for test, name in notes]
    found = F.array_compact(F.array(*new)) if new else F.array().cast(_TEXTS)
    return F.concat(F.col(CORRECTIONS), found) if CORRECTIONS in df.columns else found


# ---------------------------------------------------------------------------
# Stage two: defaults
# ---------------------------------------------------------------------------


def default_values(region: str = REGION, source: str | None = None) -> dict[str, Column]:
    empty, text = F.array().cast(_TEXTS), F.lit
    return {
        "marketing_tags": empty, "attributes": F.create_map().cast("map<string,string>"),
        "image_urls": empty, "tags": empty, "validation_errors": empty,
        "scraper_notes": text(""), "is_valid": F.lit(True), "review_count": F.lit(0),
        "stock_quantity": F.lit(0), "currency": text(CURRENCY), "region": text(region), "source": text(source),
    }


def defaults(
    df: DataFrame, region: str = REGION, source: str | None = None, scraped_at: Column | int | None = None
) -> DataFrame:
    """Fill what is null or absent; what is there stays."""
    have = _types(df)
    changes = {}
    for name, value in default_values(region, source).items():
        if name in have:
            changes[name] = F.coalesce(F.col(name), value.cast(have[name]))
        else:
            changes[name] = value.cast("string") if name == "source" else value
    now = F.unix_timestamp() if scraped_at is None else _column(scraped_at)
    changes["scraped_at"] = F.coalesce(F.col("scraped_at"), now.cast(have["scraped_at"])) if "scraped_at" in have else now

    price = have.get("price_data")
    if isinstance(price, T.StructType):
        full = T.StructType(list(price.fields))
        for extra in ("currency", "sale_tag"):
            if extra not in price.names:
                full = full.add(extra, T.StringType())
        given = F.nullif(F.col("price_data.currency"), F.lit("")) if "currency" in price.names else F.lit(None)
        fills = {"currency": F.coalesce(given, F.lit(CURRENCY))}
        if "sale_tag" not in price.names:
            fills["sale_tag"] = F.lit(None)
        changes["price_data"] = _with_fields("price_data", full, fills)

    changes |= _nested_defaults(have, "assets", ASSETS.schema, {})
    changes |= _nested_defaults(have, "stock_data", STOCK.schema, {
        "in_stock": F.lit(False), "count": F.lit(0), "status": F.lit(UNKNOWN)})
    return _replace(df, changes)


def _nested_defaults(have: dict, name: str, wanted: T.StructType, values: dict[str, Column]) -> dict[str, Column]:
    struct = have.get(name)
    if not isinstance(struct, T.StructType):
        return {}
    full = T.StructType(list(struct.fields) + [f for f in wanted.fields if f.name not in struct.names])
    fills = {}
    for f in wanted.fields:
        given = F.col(name)[f.name] if f.name in struct.names else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.ArrayType):
            fills[f.name] = F.coalesce(given, F.array().cast(full[f.name].dataType))
        elif f.name in values:
            fills[f.name] = F.coalesce(given, values[f.name].cast(full[f.name].dataType))
        else:
            fills[f.name] = given
    return {name: _with_fields(name, full, fills)}


# ---------------------------------------------------------------------------
# Stage three: normalise
# ---------------------------------------------------------------------------


def _sorted_tags(name: str) -> Column:
    """Strip, distinct, sort.  Only truly empty entries go: a blank one stays as ''."""
    kept = F.filter(F.col(name), lambda t: t.isNotNull() & (t != ""))
    return F.array_sort(F.array_distinct(F.transform(kept, strip)))


def _clean_attributes(dtype: T.MapType) -> Column:
    kept = F.map_filter("attributes", lambda k, v: (k != "") & v.isNotNull())
    value = dtype.valueType
    if isinstance(value, T.StringType):
        return F.transform_values(kept, lambda _, v: collapse(v))
    if isinstance(value, T.ArrayType):
        return F.transform_values(kept, lambda _, v: F.filter(v, lambda x: is_filled(x, value.elementType)))
    if isinstance(value, T.VariantType):
        return F.transform_values(
            F.map_filter(kept, lambda _, v: ~F.is_variant_null(v)),
            lambda _, v: F.when(F.schema_of_variant(v) == "STRING", collapse(F.try_variant_get(v, "$", "string")).cast("variant"))
            .when(F.schema_of_variant(v).startswith("ARRAY"), F.to_variant_object(
                F.filter(F.try_variant_get(v, "$", "array<variant>"), _variant_kept)))
            .otherwise(v),
        )
    return kept


def _variant_kept(v: Column) -> Column:
    number = F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    zero = number & (F.try_variant_get(v, "$", "double") == 0)
    return ~(F.is_variant_null(v) | F.to_json(v).isin('""', "[]", "{}", "false") | F.coalesce(zero, F.lit(False)))


def clean(df: DataFrame) -> DataFrame:
    """White space, tags, attributes, image lists and number ranges."""
    have = _types(df)
    changes, notes = {}, []
    for name in TEXT_FIELDS:
        if isinstance(have.get(name), T.StringType):
            changes[name] = collapse(F.col(name))
    for name in ("marketing_tags", "tags"):
        if isinstance(have.get(name), T.ArrayType):
            changes[name] = _sorted_tags(name)
    if isinstance(have.get("attributes"), T.MapType):
        changes["attributes"] = _clean_attributes(have["attributes"])
    if isinstance(have.get("image_urls"), T.ArrayType):
        changes["image_urls"] = F.array_distinct("image_urls")
    if isinstance(have.get("assets"), T.StructType):
        lists = [f.name for f in have["assets"].fields if isinstance(f.dataType, T.ArrayType)]
        changes["assets"] = _with_fields("assets", have["assets"], {
            n: F.array_distinct(F.col("assets")[n]) for n in lists})
    for name in ("price", "original_price"):
        if name in have:
            value = _number(F.col(name), have[name])
            changes[name] = F.when(value < 0, F.lit(0).cast(have[name] if isinstance(have[name], T.NumericType) else "double")).otherwise(value)
            notes.append((value < 0, f"{name}_negative"))
    if "rating" in have:
        value = _number(F.col("rating"), have["rating"])
        changes["rating"] = F.when(value.between(0, 5), value)
        notes.append((~value.between(0, 5), "rating_out_of_range"))
    if "discount_percentage" in have:
        dtype = have["discount_percentage"]
        value = F.col("discount_percentage") if isinstance(dtype, T.NumericType) else F.col("discount_percentage").try_cast("int")
        whole = value.cast("int")
        changes["discount_percentage"] = F.when(~whole.between(0, 100), F.lit(0).cast(dtype if isinstance(dtype, T.NumericType) else "int")).otherwise(value)
        notes.append((~whole.between(0, 100), "discount_out_of_range"))
    changes[CORRECTIONS] = _noted(df, notes)
    return _replace(df, changes)


def clean_description(c: Column) -> Column:
    """One line: no carriage returns, line feeds become blanks."""
    return collapse(F.translate(c, "\n\r", " "))


# ---------------------------------------------------------------------------
# The chain
# ---------------------------------------------------------------------------


def clean_products(
    df: DataFrame, region: str = REGION, source: str | None = None, scraped_at: Column | int | None = None
) -> DataFrame:
    """validate -> defaults -> clean, with the ``corrections`` made to each row."""
    return (
        df.transform(validate)
        .transform(defaults, region=region, source=source, scraped_at=scraped_at)
        .transform(clean)
    )


def correction_summary(cleaned: DataFrame) -> DataFrame:
    """Rows per kind of correction, zero included: one aggregate, no explode."""
    counts = cleaned.agg(*[
        F.count_if(F.array_contains(CORRECTIONS, kind)).alias(kind) for kind in CORRECTION_KINDS])
    pairs = ", ".join(f"'{kind}', {kind}" for kind in CORRECTION_KINDS)
    return counts.select(F.expr(f"stack({len(CORRECTION_KINDS)}, {pairs}) AS (correction, row_count)"))

"""The one rule for "this field holds something"."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def is_filled(c: Column, dtype: T.DataType) -> Column:
    """Never null: empty text, 0, false and empty collections are not filled."""
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        filled = F.length(c) > 0
    elif isinstance(dtype, T.BooleanType):
        filled = c
    elif isinstance(dtype, T.NumericType):
        filled = c != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        filled = F.size(c) > 0
    elif isinstance(dtype, T.VariantType):
        return F.exists(F.array(c), lambda v: F.coalesce(~F.is_variant_null(v), F.lit(False)))
    else:
        return c.isNotNull()
    return F.coalesce(filled, F.lit(False))


def variant_filled_sql(v: str) -> str:
    """The same rule for a value whose type is only known at run time."""
    zero = f"(schema_of_variant({v}) RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' AND try_variant_get({v}, '$', 'double') = 0)"
    empty = f"is_variant_null({v}) OR to_json({v}) IN ('\"\"', '[]', '{{}}', 'false') OR {zero}"
    return f"coalesce({v} IS NOT NULL AND NOT ({empty}), false)"


def variant_filled(column: str) -> Column:
    return F.expr(variant_filled_sql(column))

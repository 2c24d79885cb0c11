"""Type raw text into an entity: one select, driven by the entity's rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vitrine.functions import text
from vitrine.schemas import Entity

_READ = {
    "strip": text.strip,
    "title": text.clean_title,
    "price": text.parse_price,
    "float": text.extract_float,
    "number": text.extract_number,
}


def _typed(c: Column, have: T.DataType, want: T.DataType, rule: str) -> Column:
    """``c`` holds one raw value or an array of raw candidates."""
    rule, _, default = rule.partition(":")
    many = isinstance(have, T.ArrayType)
    if rule == "keep":
        return c
    if rule == "strip_each":
        values = c if many else F.when(c.isNotNull(), F.array(c))
        return F.transform(F.filter(values, lambda v: v.isNotNull()), text.strip)
    if rule == "bool":
        if not many:
            return F.when(c.isNotNull(), text.normalize_bool(c, have))
        first = F.try_element_at(F.filter(c, lambda v: v.isNotNull()), F.lit(1))
        return F.when(c.isNotNull(), text.normalize_bool(first, have.elementType))
    read = _READ[rule]
    if many:
        present = F.filter(c.cast("array<string>"), lambda v: v.isNotNull())
        value = text.take_first(F.transform(present, read))
    else:
        value = F.when(c.isNotNull(), read(c.cast("string")))
        if rule in ("strip", "title"):
            value = F.nullif(value, F.lit(""))
    value = value.try_cast(want)
    if rule == "number" and isinstance(want, T.StringType):
        value = F.nullif(value, F.lit("0"))
    if default:
        value = F.when(c.isNotNull(), F.coalesce(value, F.lit(default)))
    return value


def conform(df: DataFrame, entity: Entity) -> DataFrame:
    """Project ``df`` to the entity's columns and types.

    A raw column may be text (one value) or an array of text (candidates, the
    first usable one wins).  Declared columns that are missing become null;
    a column that already has the declared type and is no text stays as it is.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def project(name: str, want: T.DataType, rule: str) -> Column:
        if name not in have:
            return F.lit(None).cast(want).alias(name)
        source = have[name]
        if source == want and not isinstance(want, (T.StringType, T.ArrayType)):
            return F.col(name)
        return _typed(F.col(name), source, want, rule).alias(name)

    return df.select(*[project(*f) for f in entity.fields])

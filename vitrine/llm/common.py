"""Helpers of the training-data operators: arrow batches, order and running totals."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_text(column: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0))


def without_clashes(df: DataFrame, added: list[str]) -> DataFrame:
    """Input columns that an operator's own result columns replace are dropped."""
    lowered = {a.lower() for a in added}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in lowered])


def starts_by_part(totals: DataFrame, part: str, value: str, start: str) -> DataFrame:
    """From one row per part, what all earlier parts hold.  Parts are as few as tasks."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(start, F.coalesce(F.sum(value).over(earlier), F.lit(0)).cast("long"))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``most`` bytes of one text column, so that Python holds few texts at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            yield batch.slice(begin)

"""A corpus made ready for training, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm.common import table
from vitrine.llm.contamination import clean_documents
from vitrine.llm.line_dedup import dedup_lines
from vitrine.llm.order_minhash import one_of_each
from vitrine.llm.packing import pack_documents
from vitrine.llm.toxicity import without_toxic
from vitrine.sources.scratch import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return without_toxic(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the text.  Every document stays."""
    cut = dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    return cut.select([
        F.when(changed, F.col("kept_text")).otherwise(F.col("text")).alias("text") if c == "text"
        else F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars")
        if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs).select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# Fitted trees, sketches and token ids cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs

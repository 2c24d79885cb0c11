"""Benchmark items found inside documents: MinHash containment search, then exact containment.

Texts become words (runs of letters and digits, lower case) and shingles of
``WORDS`` words, each a 64-bit hash.  Test items are put into partitions by
the number of their shingles; within a partition an item's sketch is its
``SKETCH`` smallest hashes, and the partition's threshold is the largest hash
in any of its sketches.  Since an item is far shorter than a document, a
document's sketch cannot be of fixed size: for each partition it holds all
hashes up to the threshold, which is in proportion to the shingles that an
item of that size would sample.  A document that contains at least
``CONTAINMENT`` of an item's shingles holds one of its ``SKETCH`` smallest with
probability 1 - (1 - CONTAINMENT)^SKETCH or more, 99.97 % at 0.8 and 5; whole
items are always found.  Candidates are verified by the exact part of the
item's distinct shingles that the document holds.

All of it is Spark SQL functions.  Only the hashes below a threshold leave the
document, and only those of a sketch survive the join.  Items of fewer than
``WORDS`` words, null and empty texts contain and are contained in nothing.
Equal items with different ids are reported each, as are items with a null id
and different items with one id.  Rows with a repeated ``doc_id`` are one
document; rows with a null ``doc_id`` are documents of their own by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import plain_text
from vitrine.sources.scratch import cut_lineage

WORDS = 5
CONTAINMENT = 0.8
SKETCH = 5
#: Upper ends of the size partitions, in shingles.
SIZES = (8, 16, 32, 64, 128, 256, 512)


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: str, length: int = WORDS) -> Column:
    """Hash of each run of ``length`` words of an array column, in order; empty if there is none."""
    parts = ", ".join(f"{words}[i + {k}]" if k else f"{words}[i]" for k in range(length))
    return F.expr(f"""CASE WHEN size({words}) >= {length}
        THEN transform(sequence(0, size({words}) - {length}), i -> xxhash64({parts}))
        ELSE CAST(array() AS ARRAY<BIGINT>) END""")


def sketches(items: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """``item_key, item_id, item_hashes, sketch, size_class, bound``: distinct hashes, the smallest, the partition's threshold.

    ``item_key`` stands for id and text, so a null or repeated id keeps its items apart.
    """
    hashed = (items.select("item_id", F.xxhash64("item_id", plain_text()).alias("item_key"), plain_text().alias("text"))
              .dropDuplicates(["item_key"]).select("item_key", "item_id", words_of(F.col("text")).alias("item_words"))
              .select("item_key", "item_id", F.array_distinct(shingle_hashes("item_words")).alias("item_hashes"))
              .where(F.size("item_hashes") > 0))
    size_class = F.lit(0)
    for top in SIZES:
        size_class = size_class + (F.size("item_hashes") > top).cast("int")
    drawn = hashed.withColumn("sketch", F.slice(F.array_sort("item_hashes"), 1, sketch)).withColumn(
        "size_class", size_class)
    bounds = drawn.groupBy("size_class").agg(F.max(F.array_max("sketch")).alias("bound"))
    return drawn.join(bounds, "size_class")


def _without_id() -> Column:
    """Keeps documents with a null id apart; null for the others, whose id is their key."""
    return F.when(F.col("doc_id").isNull(), F.md5(plain_text().cast("binary")))


def _contained(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The columns of ``contained_items`` and ``no_id``."""
    drawn = cut_lineage(sketches(items))
    bounds = [(r["size_class"], r["bound"]) for r in drawn.select("size_class", "bound").distinct().collect()]
    wanted = drawn.select("size_class", F.explode("sketch").alias("h"), "item_key")

    rows = docs.select("doc_id", _without_id().alias("no_id"), words_of(plain_text()).alias("doc_words"))
    hashed = rows.select("doc_id", "no_id", shingle_hashes("doc_words").alias("hashes"))
    # the sketches of a document: for each size partition its hashes up to that partition's threshold
    drawn_by_size = [F.expr(f"transform(filter(hashes, h -> h <= {int(bound)}), "
                            f"h -> named_struct('size_class', {int(size_class)}, 'h', h))") for size_class, bound in bounds]
    none = F.expr("CAST(array() AS ARRAY<STRUCT<size_class: INT, h: BIGINT>>)")
    sampled = hashed.select("doc_id", "no_id", F.explode(F.concat(none, *drawn_by_size)).alias("s")).select(
        "doc_id", "no_id", "s.size_class", "s.h")
    candidates = cut_lineage(sampled.join(wanted, ["size_class", "h"]).select("doc_id", "no_id", "item_key").distinct())

    # exact: the item's distinct shingles that the candidate document holds
    ids = candidates.select(F.col("doc_id").alias("id"), F.col("no_id").alias("other")).distinct()
    found = rows.join(ids, F.expr("doc_id <=> id AND no_id <=> other")).select(
        "doc_id", "no_id", F.explode(shingle_hashes("doc_words")).alias("h"))
    all_hashes = drawn.select("item_key", F.explode("item_hashes").alias("h"))
    chosen = candidates.select(
        F.col("doc_id").alias("id"), F.col("no_id").alias("other"), F.col("item_key").alias("chosen_key"))
    shared = (found.join(all_hashes, "h").select("doc_id", "no_id", "item_key", "h").distinct()
              .join(chosen, F.expr("doc_id <=> id AND no_id <=> other AND item_key = chosen_key"), "left_semi")
              .groupBy("doc_id", "no_id", "item_key").agg(F.count("*").alias("shared")))
    sizes = drawn.select("item_key", "item_id", F.size("item_hashes").cast("long").alias("item_shingles"))
    return (shared.join(sizes, "item_key")
            .withColumn("containment", F.col("shared") / F.col("item_shingles"))
            .where(F.col("containment") >= threshold)
            .select("doc_id", "no_id", "item_id", "shared", "item_shingles", "containment"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment`` of every document that holds enough of an item."""
    return _contained(docs, items, threshold).drop("no_id")


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The documents that contain no item; all columns stay."""
    dirty = _contained(docs, items, threshold).select(
        F.col("doc_id").alias("_dirty_id"), F.col("no_id").alias("_dirty_text")).distinct()
    return docs.withColumn("_no_id", _without_id()).join(
        dirty, F.expr("doc_id <=> _dirty_id AND _no_id <=> _dirty_text"), "left_anti").drop("_no_id")

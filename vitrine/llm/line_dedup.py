"""Lines that earlier documents already hold are removed, batch by batch.

A line's key is the line trimmed of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased;
keys shorter than ``MIN_POINTS`` code points never repeat.  Documents come in
batches of ascending ``doc_id``.  The keys met so far, each with the smallest
``doc_id`` holding it, are kept as runs: tables bucketed and sorted by the
key's digest.  A batch is joined with the runs (merge joins on the bucketing,
so only the batch is shuffled): keys that are found keep their owner, keys
that are not found (the anti join) become a new run of level 0.  ``FANOUT``
runs of one level are merged into one run of the next, so a key is rewritten
once per level and there are few runs to join.

A key held by two documents loses all its lines but those of its owner.
Duplicate lines within the owner stay.  Null and empty texts are one empty
line.  Rows with the same ``doc_id`` are one document; rows with a null id are
one document that comes after all others.  Extra columns pass through, but for
those named like a result column, which are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.llm.common import plain_text, without_clashes
from vitrine.sources.scratch import new_path, remove_path

MIN_POINTS = 10
BATCHES = 4
FANOUT = 2

_BLANKS = "\t\n\x0b\x0c\r "
_LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The trimmed line with A-Z lower-cased."""
    trimmed = F.btrim(line, F.lit(_BLANKS))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.length(trimmed) == F.octet_length(trimmed)
    return F.when(ascii_only, F.lower(trimmed)).otherwise(F.translate(trimmed, upper, upper.lower()))


class LineRuns:
    """The levelled runs of line keys; each run is a table ``key, owner``."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        keys.select("key", "owner").write.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name)
        return name

    def _tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def known(self, keys: DataFrame) -> DataFrame:
        """``keys`` (one row per key) with ``earlier``, the owner of a key that a run holds."""
        owners = []
        for i, name in enumerate(self._tables()):
            run = self.spark.table(name).withColumnRenamed("owner", f"owner_{i}")
            keys = keys.join(run, "key", "left")
            owners.append(F.col(f"owner_{i}"))
        earlier = F.coalesce(*owners) if owners else F.lit(None).cast("long")
        return keys.withColumn("earlier", earlier).drop(*(f"owner_{i}" for i in range(len(owners))))

    def new(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` that no run holds."""
        for name in self._tables():
            keys = keys.join(self.spark.table(name).select("key"), "key", "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Keys no run holds, as a run of level 0; full levels are merged upwards."""
        level, run = 0, self._write(keys)
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for name in full[1:]:
                merged = merged.unionByName(self.spark.table(name))
            run = self._write(merged)
            for name in full:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def drop(self) -> None:
        for name in self._tables():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def _lines(docs: DataFrame, batches: int) -> DataFrame:
    """Keyed lines ``d, row_hash, pos, key`` with their batch, by ascending ranges of the id."""
    bounds = docs.where("doc_id IS NOT NULL").select(
        F.percentile_approx("doc_id", [(i + 1) / batches for i in range(batches - 1)], 10_000)).first()[0] or []
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("d") > bound, 1).otherwise(0)
    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("d"), plain_text().alias("text"))
    exploded = rows.select("d", F.xxhash64("text").alias("row_hash"), F.posexplode(F.split("text", "\n")))
    keyed = exploded.select("d", "row_hash", "pos", line_key(F.col("col")).alias("line"))
    return keyed.where(F.length("line") >= MIN_POINTS).select(
        batch.alias("batch"), "d", "row_hash", "pos", F.unhex(F.md5("line")).alias("key"))


def _without_lines(texts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Texts without the lines at the given places; null where no place is given."""
    for text, places in texts:
        kept, dropped = [], []
        for t, p in zip(text, places):
            if t is None:
                kept.append(None)
                dropped.append(0)
                continue
            gone = set(p.tolist())
            kept.append("\n".join([line for i, line in enumerate(t.split("\n")) if i not in gone]))
            dropped.append(len(gone))
        yield pd.DataFrame({"text": pd.Series(kept, dtype=object), "dropped": dropped})


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``d, row_hash, places``: the places of the lines that each row loses."""
    spark = docs.sparkSession
    path, out = new_path(spark, "lines"), new_path(spark, "dropped")
    _lines(docs, batches).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("d long, row_hash long, pos int, key binary, batch int").parquet(path)
    runs = LineRuns(spark)
    for number in range(batches):
        batch = lines.where(F.col("batch") == number)
        keys = batch.groupBy("key").agg(F.min("d").alias("owner"), F.max("d").alias("latest"))
        repeated = (runs.known(keys).withColumn("owner", F.coalesce("earlier", "owner"))
                    .where("latest > owner").select("key", "owner"))
        (batch.join(repeated, "key").where("d > owner").select("d", "row_hash", "pos")
         .write.mode("append").parquet(out))
        if number + 1 < batches:
            runs.add(runs.new(keys))
    runs.drop()
    remove_path(spark, path)
    found = spark.read.schema("d long, row_hash long, pos int").parquet(out)
    return found.groupBy("d", "row_hash").agg(F.collect_set("pos").alias("places"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The documents with ``kept_text``, ``n_lines`` before dropping and ``n_dropped``."""
    added = ["n_lines", "n_dropped", "kept_text", "line_d", "line_hash"]
    rows = (without_clashes(docs, added).withColumn("line_d", F.coalesce("doc_id", F.lit(_LAST)))
            .withColumn("line_hash", F.xxhash64(plain_text())))
    found = dropped_lines(docs, batches).toDF("line_d", "line_hash", "line_places")
    # only texts that lose lines go through Python
    touched = F.when(F.col("line_places").isNotNull(), plain_text())
    cut = rows.join(found, ["line_d", "line_hash"], "left").withColumn(
        "line_cut", F.pandas_udf(_without_lines, "struct<text string, dropped bigint>")(touched, F.col("line_places")))
    return cut.select(
        *[F.col(f"`{c}`") for c in rows.columns if c not in added],
        F.size(F.split(plain_text(), "\n")).cast("long").alias("n_lines"),
        F.col("line_cut.dropped").alias("n_dropped"),
        F.coalesce("line_cut.text", plain_text()).alias("kept_text"))

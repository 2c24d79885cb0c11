"""Near-duplicate vectors by E8 lattice hashing, verified by cosine.

Unit vectors are projected at random to ``TABLES`` spaces of eight dimensions,
scaled, shifted at random and decoded to the nearest point of the E8 lattice.
A vector is filed under its point, label and table, and looks for partners
under its point and the ``PROBES`` neighbouring points nearest to it.  Pairs
that meet are verified by their cosine in double precision; pairs at or above
the threshold link.  With the defaults a pair at a cosine of exactly 0.98 is
met with a probability above 0.999 (``tests/llm`` measures it).

Only vectors of equal, non-null label and equal length are compared.  Null
vectors, zero vectors and vectors with null or non-finite components link with
nothing.  Equal vectors of one label are one node, so a vector that repeats in
a third of all rows is met once; each of its copies counts as a link.  Rows
that repeat ``vec_id`` are separate vectors.  Extra columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.components import components
from vitrine.sources.scratch import cut_lineage

COSINE = 0.98
TABLES = 10
PROBES = 8
#: Scale of the projection: at the threshold, the projected distance is about 0.4 of a cell's width.
SCALE = 1.25
SEED = 20


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the differences of neighbouring points."""
    found = []
    for i in range(8):
        for j in range(i):
            for a in (1.0, -1.0):
                for b in (1.0, -1.0):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    found.append(v)
    for bits in range(256):
        signs = np.array([1.0 if bits >> k & 1 else -1.0 for k in range(8)])
        if (signs < 0).sum() % 2 == 0:
            found.append(signs / 2)
    return np.array(found)


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum of coordinates."""
    whole = np.rint(points)
    off = points - whole
    odd = np.flatnonzero(whole.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return whole


def decode(points: np.ndarray) -> np.ndarray:
    """The nearest points of E8: even-sum integer points and the same shifted by one half."""
    whole, half = _nearest_even(points), _nearest_even(points - 0.5) + 0.5
    nearer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


class LatticeTables:
    """Projections and shifts of all tables for vectors of one length."""

    def __init__(self, length: int, tables: int = TABLES, scale: float = SCALE):
        rng = np.random.default_rng([SEED, length])
        self.planes = rng.standard_normal((tables, length, 8)) * scale
        self.shifts = rng.uniform(0, 2, (tables, 8))
        self.factors = rng.integers(1 << 61, 1 << 62, (tables, 9)) * 2 + 1
        self.neighbours = minimal_vectors()

    def cells(self, units: np.ndarray, probes: int = PROBES) -> np.ndarray:
        """Codes of the own cell and of ``probes`` neighbouring cells: vectors x tables x (1 + probes)."""
        out = np.empty((len(units), len(self.planes), 1 + probes), dtype=np.int64)
        for t, plane in enumerate(self.planes):
            points = units @ plane + self.shifts[t]
            own = decode(points)
            nearness = (points - own) @ self.neighbours.T
            near = np.argpartition(-nearness, probes, axis=1)[:, :probes]
            cells = np.concatenate([own[:, None, :], own[:, None, :] + self.neighbours[near]], axis=1)
            out[:, t] = ((2 * cells).astype(np.int64) * self.factors[t, :8]).sum(axis=2) + self.factors[t, 8]
        return out


def _filed(vectors: DataFrame) -> DataFrame:
    """``key, cell, own`` of every vector: its own cell of each table and the cells it probes."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, LatticeTables] = {}
        for batch in batches:
            rows = batch.column("embedding")
            lengths = np.diff(rows.offsets.to_numpy())
            keys, begins = batch.column("key"), rows.offsets.to_numpy()[:-1]
            values = rows.values.to_numpy(zero_copy_only=False).astype(np.float64)
            labels = batch.column("label_code").to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                tables = known.setdefault(int(length), LatticeTables(int(length)))
                for part in np.array_split(at, max(1, len(at) // 2000)):
                    units = values[begins[part][:, None] + np.arange(length)]
                    units /= np.sqrt((units * units).sum(axis=1, keepdims=True))
                    # the label is part of the cell
                    codes = (tables.cells(units) ^ labels[part][:, None, None]).reshape(-1)
                    own = np.zeros((len(part), TABLES, 1 + PROBES), dtype=bool)
                    own[:, :, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(np.repeat(part, TABLES * (1 + PROBES)))), pa.array(codes),
                         pa.array(own.reshape(-1))], names=["key", "cell", "own"])

    return vectors.select("key", F.xxhash64("label").alias("label_code"), "embedding").mapInArrow(
        cells, "key string, cell bigint, own boolean")


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = []
            for name in ("vector_a", "vector_b"):
                rows = batch.column(name)
                sides.append((rows.values.to_numpy(zero_copy_only=False).astype(np.float64), rows.offsets.to_numpy()))
            (a, at_a), (b, at_b) = sides
            same = np.diff(at_a) == np.diff(at_b)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for length in np.unique(np.diff(at_a)[same]):
                rows = np.flatnonzero(same & (np.diff(at_a) == length))
                x = a[at_a[rows][:, None] + np.arange(length)]
                y = b[at_b[rows][:, None] + np.arange(length)]
                dot = (x * y).sum(axis=1)
                keep[rows] = dot / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)) >= threshold
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = (pairs.join(vectors.select(F.col("key").alias("a"), "label", F.col("embedding").alias("vector_a")), "a")
              .join(vectors.select(F.col("key").alias("b"), F.col("label").alias("label_b"),
                                   F.col("embedding").alias("vector_b")), "b").where("label = label_b"))
    return joined.select("a", "b", "vector_a", "vector_b").mapInArrow(cosines, "a string, b string")


def near_vectors(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    finite = """label IS NOT NULL AND embedding IS NOT NULL
        AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
        AND exists(embedding, x -> x <> 0)"""
    key = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col("embedding").cast("string")))
    rows = cut_lineage(vectors.select("vec_id", "label", "embedding").withColumn(
        "key", F.when(F.coalesce(F.expr(finite), F.lit(False)), key)))
    nodes = cut_lineage(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"),
        F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding")))
    filed = cut_lineage(_filed(nodes))
    met = filed.where("own").select("cell", F.col("key").alias("x")).join(
        filed.select("cell", F.col("key").alias("y")), "cell").where("x <> y")
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    links = cut_lineage(_verified(pairs, nodes, threshold))

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(nodes.select(F.col("key").alias("b"), "copies"), "b").groupBy("a").agg(
        F.sum("copies").alias("near")).withColumnRenamed("a", "key")
    groups = components(links).withColumnRenamed("node", "key")
    placed = (nodes.select("key", "first_id", "copies").join(degree, "key", "left").join(groups, "key", "left")
              .withColumn("component", F.coalesce("component", "key")))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_key = placed.join(smallest, "component").select(
        "key", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component_id")
    return rows.select("vec_id", "key").join(by_key, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""Clusters of vectors: rounds of exact k-means in whole numbers, filtered in rotated coordinates.

Components become whole numbers, ``floor(scale * x)``.  The covariance of all
vectors gives a rotation onto its principal axes; of each vector the ``LEADING``
first rotated coordinates and the norm of the rest are stored beside the whole
numbers.  For a vector and a centroid, the squared distance of the leading
coordinates plus the squared difference of the two rest norms never exceeds
their squared distance.  So the centroid with the least bound is measured
first, and then only the centroids whose bound does not pass that distance, all
in whole numbers.

Each round is one pass: tasks add up their vectors per centroid, Spark adds up
the tasks, and the driver sees one sum per centroid and component.

Only vectors with exactly ``DIMENSIONS`` components, none null or non-finite,
are kept.  The first centroids are the kept vectors with the least sha256 of
``1:<vec_id>`` (a null id is written as nothing; rows with one id follow in
the order of their components); there are fewer where fewer vectors are kept.
Repeated rows count each.  Components beyond ``LARGEST`` count as that, which
keeps every distance within a long; an inertia beyond a long is null.  An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.vectors import by_length, floored, usable
from vitrine.sources.scratch import cut_lineage

DIMENSIONS, CLUSTERS, ROUNDS, SCALE = 64, 16, 3, 64
LEADING = 12
LARGEST = 1 << 27
CHUNK_ROWS = 4096


class Rotation:
    """Principal axes round a centre; ``leading`` coordinates and the norm of what they leave out."""

    def __init__(self, centre: np.ndarray, axes: np.ndarray):
        self.centre, self.axes = centre, axes

    def of(self, whole: np.ndarray) -> np.ndarray:
        """Leading coordinates, then the norm of the rest."""
        off = whole - self.centre
        turned = off @ self.axes
        rest = np.maximum((off * off).sum(axis=1) - (turned * turned).sum(axis=1), 0.0)
        return np.concatenate([turned, np.sqrt(rest)[:, None]], axis=1)


def nearest(whole: np.ndarray, filed: np.ndarray, centroids: np.ndarray, rotated: np.ndarray) -> tuple:
    """Number and squared distance of the nearest centroid of each vector, ties to the smaller number.

    ``whole`` and ``centroids`` hold whole numbers, ``filed`` and ``rotated`` what
    ``Rotation.of`` says of them.
    """
    # what rounding can add to a bound, at most
    slack = 1e-6 * (1.0 + (filed * filed).sum(axis=1, keepdims=True) + (rotated * rotated).sum(axis=1))
    bounds = ((filed * filed).sum(axis=1, keepdims=True) + (rotated * rotated).sum(axis=1)
              - 2.0 * filed @ rotated.T) - slack
    chosen = bounds.argmin(axis=1)
    off = whole - centroids[chosen]
    distance = (off * off).sum(axis=1)
    for c in range(len(centroids)):
        left = np.flatnonzero(bounds[:, c] <= distance)
        off = whole[left] - centroids[c]
        found = (off * off).sum(axis=1)
        better = (found < distance[left]) | ((found == distance[left]) & (c < chosen[left]))
        distance[left[better]], chosen[left[better]] = found[better], c
    return chosen, distance


def _matrix(rows: pa.ListArray, dtype) -> np.ndarray:
    values = rows.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(rows), -1).astype(dtype)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            yield batch.slice(at, CHUNK_ROWS)


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, whole``: the vectors that count, as whole numbers."""
    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            for _, components in by_length(batch.column("embedding")):
                whole = np.clip(floored(components, scale), -LARGEST, LARGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists(whole)], names=["vec_id", "whole"])

    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable())
            .where(F.size("embedding") == dimensions).mapInArrow(floors, "vec_id long, whole array<long>"))


def principal_axes(kept: DataFrame, dimensions: int, leading: int) -> Rotation:
    """Centre and leading axes of all vectors, from sums of their components and products."""
    size = dimensions * (dimensions + 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, products = 0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
        for batch in _chunks(batches):
            x = _matrix(batch.column("whole"), np.float64)
            rows, total, products = rows + len(x), total + x.sum(axis=0), products + x.T @ x
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, size)), pa.array(np.concatenate([[rows], total, products.reshape(-1)]))],
                names=["at", "value"])

    added = kept.select("whole").mapInArrow(sums, "at long, value double").groupBy("at").agg(F.sum("value"))
    found = np.zeros(size + 1)
    for at, value in added.collect():  # one row for each pair of components
        found[at + 1] = value
    rows = max(1.0, found[0])
    centre = found[1:dimensions + 1] / rows
    covariance = found[dimensions + 1:].reshape(dimensions, dimensions) / rows - np.outer(centre, centre)
    _, axes = np.linalg.eigh(covariance)  # by rising variance
    return Rotation(centre, axes[:, ::-1][:, :leading])


def first_centroids(kept: DataFrame, clusters: int) -> np.ndarray:
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    drawn = kept.select("whole", F.sha2(name.cast("binary"), 256).alias("drawn"))
    return np.array([r["whole"] for r in drawn.orderBy("drawn", "whole").limit(clusters).collect()], dtype=np.int64)


def moved(filed: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Centroids after one round; one without vectors stays."""
    count, dimensions = centroids.shape
    rotated = rotation.of(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((count, dimensions), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for batch in _chunks(batches):
            whole = _matrix(batch.column("whole"), np.int64)
            chosen, _ = nearest(whole, _matrix(batch.column("filed"), np.float64), centroids, rotated)
            order = np.argsort(chosen, kind="stable")
            found, begins = np.unique(chosen[order], return_index=True)
            if len(found):
                total[found] += np.add.reduceat(whole[order], begins, axis=0)
                rows[found] += np.diff(np.append(begins, len(order)))
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, dimensions)), pa.array(np.tile(np.arange(dimensions), len(used))),
            pa.array(total[used].reshape(-1)), pa.array(np.repeat(rows[used], dimensions)),
        ], names=["cluster", "at", "total", "rows"])

    added = (filed.select("whole", "filed").mapInArrow(sums, "cluster long, at long, total long, rows long")
             .groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")), F.sum("rows")))
    after = centroids.copy()
    for cluster, at, total, rows in added.collect():  # one row for each component of a centroid
        after[cluster, at] = int(total) // rows
    return after


def assigned(filed: DataFrame, centroids: np.ndarray, rotation: Rotation) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    rotated = rotation.of(centroids)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            chosen, distance = nearest(_matrix(batch.column("whole"), np.int64),
                                       _matrix(batch.column("filed"), np.float64), centroids, rotated)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(chosen.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    return filed.mapInArrow(places, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    dimensions: int = DIMENSIONS, scale: int = SCALE, leading: int = LEADING) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    kept = cut_lineage(kept_vectors(vectors, dimensions, scale))
    centroids = first_centroids(kept, clusters)
    if not len(centroids):
        return kept.select("vec_id", *(F.lit(None).cast(kind).alias(name) for name, kind in (
            ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
            ("centroid_sha256", "string"))))
    rotation = principal_axes(kept, dimensions, leading)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            filed = rotation.of(_matrix(batch.column("whole"), np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(filed)], names=["vec_id", "whole", "filed"])

    filed = cut_lineage(kept.mapInArrow(turned, "vec_id long, whole array<long>, filed array<double>"))
    for _ in range(rounds):
        centroids = moved(filed, centroids, rotation)
    placed = cut_lineage(assigned(filed, centroids, rotation))
    sums = {r["cluster"]: r["total"] for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # one row for each centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def each(values: list, kind: str):
        return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)

    def held(value) -> int | None:
        return int(value) if value < 1 << 63 else None

    return placed.select(
        "vec_id", "cluster", "distance",
        each([held(sums.get(c, 0)) for c in range(len(names))], "long").alias("cluster_inertia"),
        F.lit(held(sum(sums.values()))).cast("long").alias("inertia"), each(names, "string").alias("centroid_sha256"))

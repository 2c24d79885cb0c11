"""Vectors of an Arrow list column as matrices of whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def usable(column: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(column).isNotNull() & whole, F.lit(False))


def by_length(rows: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length found, the places of its vectors and their components as doubles."""
    offsets = rows.offsets.to_numpy()
    values = rows.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        yield places, values[offsets[places][:, None] + np.arange(length)]


def floored(components: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as doubles; a product beyond the largest double counts as that."""
    largest = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.floor(np.clip(components * scale, -largest, largest))

"""Columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its components are finite numbers."""
    wide = vector.cast("array<double>")
    sound = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A list column as rows of doubles, shorter ones filled up with zeros, and the lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(int(lengths.max(initial=0)), width or 0)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width), lengths
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = values
    return rows, lengths

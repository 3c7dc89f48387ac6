"""Vectors as integers: which rows take part, and what bounds exact arithmetic on them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Exact sums stay within signed 64-bit integers below this.
EXACT = 1 << 62


def usable(vector):
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def scaled(vector, scale: int):
    """Each component x as floor(scale * x), x taken as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def extent(rows: DataFrame, vector="values"):
    """(longest vector, largest magnitude of a component), 0 and 0 without rows."""
    sizes = rows.agg(
        F.max(F.size(vector)).alias("longest"),
        F.max(F.greatest(F.array_max(vector), -F.array_min(vector))).alias("largest"),
    ).first()
    return sizes["longest"] or 0, sizes["largest"] or 0


def matrix(column, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out

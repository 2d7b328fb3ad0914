"""What the operators on vectors share: which rows count, and vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def finite(vector: str) -> Column:
    """True for a vector that is there and holds neither nulls nor non-finite values."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good, F.lit(False))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors without nulls as doubles; shorter ones are filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out

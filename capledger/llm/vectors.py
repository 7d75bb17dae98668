"""Helpers for vector operators: which vectors take part, batches as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column of equally long vectors without nulls as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(column), width)

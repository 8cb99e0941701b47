"""Shared steps of the vector operators: which vectors take part, and equal vectors as one class."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "vector is null or empty, or has a null, a non-finite number or nothing but zeros"


def usable(column: str) -> Column:
    """Whether a vector has numbers only, at least one of them not 0."""
    x = F.col(column)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(whole & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def pairwise_dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner product of each row of x with the same row of y. The result of a pair does not depend on the other rows."""
    return (x * y).sum(axis=1)


def dimension(rows: DataFrame, column: str) -> int | None:
    """The length of the vectors, or None if there are none. Vectors of several lengths can't be compared: an error."""
    lengths = rows.select(F.size(column).alias("n")).distinct().limit(2).collect()
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(r['n'] for r in lengths)}")
    return lengths[0]["n"] if lengths else None

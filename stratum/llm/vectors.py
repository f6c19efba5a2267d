"""Embedding columns as matrices: which rows hold a usable vector, and Arrow lists as two-dimensional arrays."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """The vector is not null and holds neither nulls nor non-finite entries. (An empty vector is usable.)"""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def common_length(df: DataFrame, vector: str) -> int:
    """The most frequent length of a vector column, of equally frequent ones the longest; 0 for an empty table."""
    sizes = df.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max(F.struct("n", "d"))["d"]).first()[0] or 0


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """An Arrow list column, every list ``d`` long and without nulls, as a double matrix of one row per list."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)

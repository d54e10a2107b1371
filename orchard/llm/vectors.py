"""Helpers for vector columns (arrays of numbers)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null or empty, every component finite, not all of them zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, column: str) -> int:
    """The most frequent length; vectors of another length take no part."""
    r = df.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return r["d"] if r else 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column without nulls as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random rotation, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def row_dots(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Inner products of rows x[i] with rows y[j] in double precision; the sum
    of a pair does not depend on what else is in the call."""
    out = np.empty(i.size)
    for lo in range(0, i.size, step):
        out[lo : lo + step] = (x[i[lo : lo + step]] * y[j[lo : lo + step]]).sum(1)
    return out

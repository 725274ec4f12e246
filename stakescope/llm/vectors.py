"""Vectors in Arrow batches as padded matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """True for vectors without null or non-finite components (false for null vectors)."""
    inside = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & inside, F.lit(False))


def matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column as one matrix; shorter rows are padded with zeros, which add nothing to an inner product."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    n = np.diff(offsets)
    width = int(n.max()) if len(n) else 0
    if len(n) and int(n.min()) == width:
        return values.reshape(len(n), width)
    out = np.zeros((len(n), width), values.dtype)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], n)] = values
    return out


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] >= width else np.hstack([m, np.zeros((len(m), width - m.shape[1]), m.dtype)])


def stacked(ms: list[np.ndarray]) -> np.ndarray:
    width = max((m.shape[1] for m in ms), default=0)
    return np.vstack([widened(m, width) for m in ms]) if ms else np.zeros((0, 0))


def top(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best (query, score, vec) rows: highest score first, ties to the smaller vec."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def query_set(rows: DataFrame, every: int, id_col: str = "vec_id", vector: str = "v") -> DataFrame:
    """Rows whose id is divisible by `every`, one for each id."""
    return rows.where(F.col(id_col) % every == 0).groupBy(id_col).agg(F.min(vector).alias(vector))

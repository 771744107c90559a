"""Vectors of embeddings in Arrow batches and in SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def matrix(column: pa.Array, width: int, dtype: type = np.float64) -> np.ndarray:
    """The vectors of a column as rows, shorter ones continued by zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(lengths) and lengths.min() == width:
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, at] = flat
    return out


def best(owner: np.ndarray, score: np.ndarray, ties: list[np.ndarray], k: int) -> np.ndarray:
    """Which entries are among the first ``k`` of their owner, by falling score and then by rising ``ties``."""
    order = np.lexsort((*reversed(ties), -score, owner))
    owned = owner[order]
    new = np.ones(len(owned), bool)
    new[1:] = owned[1:] != owned[:-1]
    start = np.flatnonzero(new)
    place = np.arange(len(owned)) - np.repeat(start, np.diff(np.append(start, len(owned))))
    return order[place < k]

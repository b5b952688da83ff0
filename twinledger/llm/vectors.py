"""Vectors in tasks: matrices from Arrow lists, pivots, distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Not NULL, not empty, and without NULL, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """One row a vector, shorter ones ended with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(square, 0))


def sample(df: DataFrame, id_col: str, column: str, most: int, width: int) -> np.ndarray:
    """``most`` vectors picked by the hash of their ids, the bound of what the driver gets."""
    picked = df.orderBy(F.xxhash64(id_col, F.lit(17)), id_col).limit(most).select(column).toPandas()
    return matrix(picked[column], width)

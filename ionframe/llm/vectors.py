"""Vectors as Spark columns and numpy blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """True for vectors that are not null, not zero and hold only finite components."""
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def block(series: pd.Series, dim: int) -> np.ndarray:
    """Rows of a vector column as a double matrix."""
    if not len(series):
        return np.zeros((0, dim))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)) if len(x) else x

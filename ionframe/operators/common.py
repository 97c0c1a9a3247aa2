"""Small shared helpers: required columns, null-safe joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required columns {missing}; has {df.columns}")


def join_on_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal ``keys`` treating null = null (a null group from a
    ``groupBy`` joins back to its rows); the right side's key columns are
    dropped, as with ``on=keys``."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"_rk_{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_rk_{i}")) for i, k in enumerate(keys)]
    if not cond:
        raise ValueError("join_on_keys needs at least one key")
    return left.join(r, on=cond, how=how).drop(*[f"_rk_{i}" for i in range(len(keys))])


def is_number(df: DataFrame, name: str) -> Column:
    """Whether a column has a value that orders: neither null nor, among floats, NaN."""
    known = F.col(name).isNotNull()
    return known & ~F.isnan(F.col(name)) if dict(df.dtypes)[name] in ("float", "double") else known

"""Vectors as whole numbers, for the operators whose arithmetic is exact.

A component x becomes floor(scale * x).  A vector takes part if it is not
null and every component is there, finite, and fits a long after scaling.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest magnitude of a scaled component (longs beyond 2 ** 53 come from doubles, so this is a double as well).
LIMIT = float(1 << 62)


def usable(vector: str, scale: float, limit: float = LIMIT) -> Column:
    """The vector takes part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * F.lit(scale)) > F.lit(limit)))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def whole(vector: str, scale: float) -> Column:
    """array<long> of floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def exact(x: np.ndarray, room: int) -> np.ndarray:
    """``x`` in the cheapest type that holds ``room`` * (2 max|x|) ** 2 exactly:
    int32, int64 or Python's integers."""
    top = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    need = room * (2 * top + 2) ** 2
    return x.astype(np.int32 if need < 1 << 31 else np.int64 if need < 1 << 63 else object)


def matrix(column: pa.ListArray, rows: np.ndarray, dim: int) -> np.ndarray:
    """The vectors at ``rows`` (all of length ``dim``) as int64 [rows, dim]."""
    taken = column.take(pa.array(rows))
    return taken.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), dim)


def as_long(values: Iterable) -> list:
    """Whole numbers as longs; what a long cannot hold is null."""
    return [int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values]


def decimals(values: Iterable) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def floor_mean(total: int, n: int) -> int:
    """floor(total / n) of Python integers, exactly."""
    return int(total) // int(n)



"""Vectors of floating point numbers as vectors of whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Whole components stay below this, so that squared distances and their sums fit a long.
LARGEST = 1 << 24


def usable(df: DataFrame, dims: int, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has ``dims`` components, none of them null or not finite."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) == dims) & ~broken)


def largest(df: DataFrame, vector: str = "embedding") -> tuple[int, int]:
    """Smallest and largest whole component of usable rows; 0 and 0 without rows. One that reaches
    ``LARGEST`` is an error, as exact results would not fit a long; no row is dropped for that."""
    low, high = df.agg(F.min(F.array_min(vector)), F.max(F.array_max(vector))).first()
    if low is None:
        return 0, 0
    low, high = (int(np.floor(SCALE * np.float64(x))) for x in (low, high))
    if max(-low, high) >= LARGEST:
        raise ValueError(f"components beyond {LARGEST // SCALE} have no exact distances in a long")
    return low, high


def whole(vectors: pa.Array, dims: int) -> np.ndarray:
    """Floored and scaled components, one row per vector."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(-1, dims)


def floored_means(sums: DataFrame, keys: list[str]) -> dict[tuple, tuple[int, int]]:
    """(n, floor of total / n) by ``keys`` from partial sums (keys, n, total); the caller's keys
    are a bounded set, so few rows reach the driver. Division is that of whole numbers."""
    total = F.sum(F.col("total").cast("decimal(20,0)"))
    rows = sums.groupBy(*keys).agg(F.sum("n").alias("n"), total.alias("total")).collect()
    return {tuple(r[k] for k in keys): (r["n"], int(r["total"]) // r["n"]) for r in rows}


def decimal_sha256(numbers) -> str:
    """Lower-case hex SHA-256 of whole numbers in decimal, joined by commas."""
    import hashlib

    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()


def label_key(label: Column) -> Column:
    """A key that is never null, so that rows without a label are one group."""
    return F.struct(label.isNull().alias("missing"), F.coalesce(label, F.lit(0)).alias("label"))

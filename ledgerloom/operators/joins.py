"""Joins whose small side is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000
SURELY_SMALL_BYTES = 8 << 20
SALTS = 32


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of a relation's size; starts no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether a relation is known to be small or has at most ``max_rows`` rows.

    Relations estimated below ``SURELY_SMALL_BYTES`` are not counted. Others are: that sends one
    number per task, where a limit would send rows to one task.
    """
    if max_rows >= MAX_BROADCAST_ROWS and estimated_bytes(df) <= SURELY_SMALL_BYTES:
        return True
    return df.count() <= max_rows


def salted(left: DataFrame, right: DataFrame, salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Spread each key of ``left`` over ``salts`` buckets and copy ``right`` into each.

    The salt is a hash of the row, so a task that runs again after an executor is lost puts
    every row into the same bucket as before.
    """
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return left.withColumn("_salt", salt), right.withColumn("_salt", copies)


def lookup_join(
    left: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    salts: int = SALTS,
    small: bool | None = None,
) -> DataFrame:
    """Equi-join a large side to a lookup side (how: inner, left, left_semi, left_anti).

    A lookup side of proven size is broadcast, so the large side is not shuffled. A larger
    one is joined by a shuffle on the key and a salt, so that a key holding a large share of
    the left rows is spread over many tasks; copies of one row, which share a salt, are left
    to adaptive skew splitting. The copies of the lookup side are not in the optimizer's estimate,
    so a hint keeps it from broadcasting them. ``small`` tells what the caller already knows of the
    size.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join cannot be {how}")
    if small is None:
        small = is_small(dim, max_broadcast_rows)
    if small:
        return left.join(F.broadcast(dim), on, how)
    left, dim = salted(left, dim, salts)
    return left.join(dim.hint("merge"), [*on, "_salt"], how).drop("_salt")

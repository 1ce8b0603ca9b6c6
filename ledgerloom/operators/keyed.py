"""Keys: duplicates, distinct values, missing partners, default rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_blank


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "n_records") -> DataFrame:
    """Keys held by more than one row; NULLs form a key of their own."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def distinct_count_over(
    df: DataFrame, key: str, value: str, limit: int = 1, count: str = "distinct_count"
) -> DataFrame:
    """Keys with more than ``limit`` distinct values."""
    return df.groupBy(key).agg(F.count_distinct(value).alias(count)).filter(F.col(count) > limit)


def global_having(df: DataFrame, limit: int = 1, count: str = "row_count") -> DataFrame:
    """One row with the number of rows if that exceeds ``limit``, else none."""
    return df.agg(F.count("*").alias(count)).filter(F.col(count) > limit)


def missing_in_dim(
    df: DataFrame, dim: DataFrame, columns: dict[str, str], trim: bool = True
) -> DataFrame:
    """Distinct non-blank key values without a partner in ``dim``, both sides trimmed.

    ``columns`` maps columns of ``df`` to those of ``dim``.
    """
    def value(name: str) -> Column:
        return F.btrim(name) if trim else F.col(name)

    keys = df
    for name in columns:
        keys = keys.filter(~is_blank(F.col(name)))
    keys = keys.select(*(value(c).alias(c) for c in columns)).distinct()
    known = dim.select(*(value(d).alias(c) for c, d in columns.items())).distinct()
    # Both sides are distinct, so no key is hot.
    return keys.join(known, list(columns), "left_anti")


def split_to_rows(df: DataFrame, column: str, out: str, pattern: str = ",") -> DataFrame:
    """Distinct trimmed parts of a separated text column."""
    parts = df.filter(~is_blank(F.col(column))) \
        .select(F.explode(F.split(F.col(column), pattern)).alias(out))
    return parts.select(F.btrim(out).alias(out)).distinct()


def else_default_row(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """The relation, or one default row if it is empty (columns not named are NULL).

    The relation is read twice; store it first if it is costly.
    """
    empty = df.select(F.lit(1)).limit(1).agg(F.count("*").alias("_rows")).filter("_rows = 0")
    row = empty.select(*(
        defaults.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema
    ))
    return df.unionByName(row)

"""Which rows count: the newest loaded batch, active rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch_id(
    registry: DataFrame, source_system: str, source_object: str, raw_table: str
) -> DataFrame:
    """One row: the highest id among loaded batches of one source (NULL if none)."""
    return registry.filter(
        (F.col("source_system") == source_system)
        & (F.col("source_object") == source_object)
        & (F.col("raw_table") == raw_table)
        & (F.col("status") == "loaded")
    ).agg(F.max("ingestion_id").alias("ingestion_id"))


def latest_batch(
    raw: DataFrame, registry: DataFrame, source_system: str, source_object: str, raw_table: str
) -> DataFrame:
    """Rows of the newest loaded batch.

    The id is a scalar subquery, so a raw table partitioned by ``ingestion_id`` is pruned to
    one partition before it is read.
    """
    newest = latest_batch_id(registry, source_system, source_object, raw_table)
    return raw.filter(F.col("ingestion_id") == newest.scalar())


def filter_active(df: DataFrame, flag: str = "is_active_account") -> DataFrame:
    """Rows whose flag is true; NULL is not."""
    return df.filter(F.col(flag).eqNullSafe(True))

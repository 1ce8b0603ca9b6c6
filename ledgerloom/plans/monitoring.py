"""Freshness and volume of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import (
    age_seconds, deviation_pct, duration_text, freshness_class, volume_class,
)
from ledgerloom.operators.loads import baseline_stats, latest_vs_baseline, load_rank

_ENTRY = [
    "ingestion_id", "source_system", "source_object", "raw_table", "s3_bucket", "s3_key",
    "file_size_bytes",
]


def freshness(registry: DataFrame, as_of: Column) -> DataFrame:
    """One row about the newest successful load, also when there is none.

    A global aggregate always yields one row, so the empty case needs no second pass.
    """
    columns = [*_ENTRY, "rows_loaded", "discovered_at", "started_at", "finished_at"]
    newest = F.struct(F.col("finished_at").isNull(), "finished_at", "ingestion_id")
    last = registry.filter(F.col("status") == "loaded") \
        .agg(F.max_by(F.struct(*columns), newest).alias("last")).select("last.*")
    seconds = age_seconds(as_of, F.col("finished_at"))
    return last.select(
        *columns[:-1],
        F.col("finished_at").alias("last_successful_load_at"),
        as_of.alias("checked_at"),
        seconds.alias("seconds_since_last_load"),
        duration_text(seconds).alias("time_since_last_load_text"),
        freshness_class(F.col("finished_at"), seconds).alias("freshness_status"),
    )


def volume_monitoring(registry: DataFrame, as_of: Column) -> DataFrame:
    """The latest load of each source against the seven loads before it."""
    loaded = registry.filter(F.col("status") == "loaded")
    ranked = load_rank(loaded, upto=8)
    average = F.col("avg_rows_loaded")
    return latest_vs_baseline(ranked, baseline_stats(ranked)).select(
        *_ENTRY,
        F.col("finished_at").alias("latest_load_at"),
        F.col("rows_loaded").alias("latest_rows_loaded"),
        "baseline_load_count", "avg_rows_loaded", "min_rows_loaded", "max_rows_loaded",
        deviation_pct(F.col("rows_loaded"), average).alias("deviation_pct"),
        volume_class(F.col("rows_loaded"), F.col("baseline_load_count"), average)
        .alias("volume_status"),
        as_of.alias("checked_at"),
    )

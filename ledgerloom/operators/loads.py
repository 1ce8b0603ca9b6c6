"""History of loads: ranks, baselines, latest success."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID_BLOCK = 1_000_000
LOAD_KEY = ["source_system", "source_object", "raw_table"]


def newest_first() -> list[Column]:
    """Newest load first; a load without an end counts as newest, ties go to the higher id."""
    return [F.col("finished_at").desc_nulls_first(), F.col("ingestion_id").desc()]


def load_rank(loads: DataFrame, keys: list[str] = LOAD_KEY, upto: int | None = None) -> DataFrame:
    """Rank of each load within its source, newest first.

    With ``upto`` only the first ranks are kept, and Spark cuts each group to them before
    the shuffle. Without it, a source is ranked hour by hour and the loads of later hours are
    added from hourly counts, so a source with a large share of all loads is not one task.
    """
    if upto is not None:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first()))
        return loads.withColumn("load_rank", rank.cast("long")).filter(F.col("load_rank") <= upto)
    # Loads without an end share no hour; they are ranked by id and cut by that.
    block = F.when(F.col("finished_at").isNull(), F.floor(F.col("ingestion_id") / ID_BLOCK))
    parts = [*keys, "_hour", "_block"]
    dated = loads.withColumn("_hour", F.date_trunc("hour", "finished_at")).withColumn("_block", block)
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_hour").desc_nulls_first(), F.col("_block").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = dated.groupBy(*parts).agg(F.count("*").alias("_loads")) \
        .withColumn("_later", F.coalesce(F.sum("_loads").over(later), F.lit(0))) \
        .select(*(F.col(k).alias(f"_k_{k}") for k in parts), "_later")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in parts])
    in_part = F.row_number().over(Window.partitionBy(*parts).orderBy(*newest_first()))
    return dated.withColumn("_rank", in_part).join(counts, same).select(
        *loads.columns, (F.col("_rank") + F.col("_later")).cast("long").alias("load_rank")
    )


def baseline_stats(ranked: DataFrame, first: int = 2, last: int = 8,
                   keys: list[str] = LOAD_KEY) -> DataFrame:
    """Row counts of the loads before the latest one."""
    total = F.sum("rows_loaded").cast("decimal(20,0)")
    return ranked.filter(F.col("load_rank").between(first, last)).groupBy(*keys).agg(
        F.count("*").alias("baseline_load_count"),
        F.round(total / F.count("rows_loaded"), 2).cast("decimal(18,2)").alias("avg_rows_loaded"),
        F.min("rows_loaded").alias("min_rows_loaded"),
        F.max("rows_loaded").alias("max_rows_loaded"),
    )


def latest_vs_baseline(ranked: DataFrame, baseline: DataFrame,
                       keys: list[str] = LOAD_KEY) -> DataFrame:
    """The latest load of each source next to its baseline, if it has one."""
    latest = ranked.filter(F.col("load_rank") == 1)
    return latest.join(baseline, keys, "left")


def last_successful_load(registry: DataFrame) -> DataFrame:
    """The newest loaded entry: at most one row."""
    return registry.filter(F.col("status") == "loaded").orderBy(*newest_first()).limit(1)

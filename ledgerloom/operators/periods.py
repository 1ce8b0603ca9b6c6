"""Days and periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import is_period_end, period_label
from ledgerloom.schemas import GRAINS


def calendar_spine(df: DataFrame, start: str, end: Column, day: str) -> DataFrame:
    """One row per day from a row's start to end; a start after the end gives no rows."""
    return df.filter(F.col(start) <= end).withColumn(
        day, F.explode(F.sequence(F.col(start), end))
    )


def with_periods(df: DataFrame, day: Column, grains: list[str] = GRAINS) -> DataFrame:
    """Each row with a list of its periods, one per grain, to be spread by ``unpack_periods``.

    Labels are built once per row, whatever multiplies the rows in between.
    """
    rows = df.withColumn("_day", day)
    label = [_period(name, period_label(F.col("_day"), name)) for name in grains]
    return rows.withColumn("_periods", F.array(*label)).drop("_day")


def with_closing_periods(
    df: DataFrame, day: str, last_day: Column, grains: list[str] = GRAINS
) -> DataFrame:
    """As ``with_periods`` for the periods that end on a row's day; days that end none are left out."""
    ends = {name: is_period_end(F.col(day), F.lit(name), last_day) for name in grains}
    if "Day" not in ends:
        df = df.filter(reduce(Column.__or__, ends.values()))
    # Lists of one or none, put together by an expression that compiles.
    found = [F.array(_period(name, period_label(F.col(day), name))) for name in ends]
    periods = [F.when(end, one).otherwise(F.slice(one, 1, 0)) for end, one in zip(ends.values(), found)]
    return df.withColumn("_periods", F.concat(*periods))


def in_own_stage(df: DataFrame, column: str) -> DataFrame:
    """The same rows; what multiplies them further is not compiled together with what made them.

    A compiled stage holds all rows that it makes of one input row until that row is done: days, currencies and
    periods of a run in one stage would be held at once. A higher-order function, here one that changes nothing,
    is not compiled, so a stage ends there. ``column`` is a nullable one that needs no computing.
    """
    return df.withColumn(column, F.get(F.transform(F.array(column), lambda value: value), F.lit(0)))


def _period(grain: str, label: Column) -> Column:
    return F.struct(F.lit(grain).alias("period_grain"), label.alias("period"))


def unpack_periods(df: DataFrame) -> DataFrame:
    """One row per period of each row."""
    return df.select(*(c for c in df.columns if c != "_periods"), F.inline("_periods"))


def lateral_unpivot(df: DataFrame, day: Column, grains: list[str] = GRAINS) -> DataFrame:
    """One row per period grain with the label of the period the day falls into."""
    return unpack_periods(with_periods(df, day, grains))


def period_ends(
    df: DataFrame, day: str, last_day: Column, grains: list[str] = GRAINS
) -> DataFrame:
    """From gap-free daily rows up to ``last_day``, the last row of every period.

    The last day of a period is known from the calendar alone, so no ranking is needed.
    """
    return unpack_periods(with_closing_periods(df, day, last_day, grains))


def period_end_snapshot(
    df: DataFrame, keys: list[str], day: str, values: list[str], grains: list[str] = GRAINS
) -> DataFrame:
    """The last row per key, grain and period for daily rows that may have gaps."""
    rows = lateral_unpivot(df, F.col(day), grains)
    last = F.max_by(F.struct(day, *values), F.col(day)).alias("_last")
    return rows.groupBy(*keys, "period_grain", "period").agg(last).select(
        *keys, "period_grain", "period", F.col(f"_last.{day}").alias("period_end"),
        *(F.col(f"_last.{v}").alias(v) for v in values),
    )

"""Labels shown on dashboards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import DISPLAY_TYPES, FRESH_SECONDS, GRAINS, WARNING_SECONDS


def display_type(ledger_type: Column) -> Column:
    """Canonical type to label; types without a label give NULL."""
    label = F.lit(None).cast("string")
    for canonical, shown in DISPLAY_TYPES.items():
        label = F.when(ledger_type == canonical, shown).otherwise(label)
    return label


def expense_type(recurring: Column, reserve_funded: Column) -> Column:
    return F.when(recurring, "Recurring").when(reserve_funded, "Reserve-funded").otherwise("Ad hoc")


def account_type(reserve: Column, credit: Column) -> Column:
    return F.when(reserve, "Reserve").when(credit, "Credit").otherwise("Standard")


def period_label(day: Column, grain: str) -> Column:
    """Label of the period of one grain that a date falls into."""
    if grain == "Day":
        return day.cast("string")
    if grain == "Week":
        return F.trunc(day, "week").cast("string")
    if grain == "Month":
        return F.substring(day.cast("string"), 1, 7)
    if grain == "Quarter":
        return F.concat(
            F.substring(day.cast("string"), 1, 4), F.lit("-Q"), F.quarter(day).cast("string")
        )
    if grain == "Year":
        return F.substring(day.cast("string"), 1, 4)
    raise ValueError(f"unknown grain: {grain}")


def period_label_of(day: Column, grain: Column, grains: list[str] = GRAINS) -> Column:
    """As ``period_label`` for a grain held in a column, so a label is built only where used."""
    label = F.lit(None).cast("string")
    for name in grains:
        label = F.when(grain == name, period_label(day, name)).otherwise(label)
    return label


def is_period_end(day: Column, grain: Column, last_day: Column) -> Column:
    """Whether a day is the last one of its period in a gap-free run of days up to last_day."""
    following = F.date_add(day, 1)
    closes = (
        F.when(grain == "Day", F.lit(True))
        .when(grain == "Week", F.dayofweek(following) == 2)
        .when(grain == "Month", F.day(following) == 1)
        .when(grain == "Quarter", (F.day(following) == 1) & (F.month(following) % 3 == 1))
        .when(grain == "Year", F.dayofyear(following) == 1)
    )
    return closes | (day == last_day)


def age_seconds(as_of: Column, ts: Column) -> Column:
    """Whole seconds from ts to as_of, rounded."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return F.round(micros / F.lit(1000000)).cast("long")


def duration_text(seconds: Column) -> Column:
    """Seconds as ``D d H h M min``."""

    def units(value: Column, name: str) -> Column:
        return F.concat(F.floor(value).cast("long").cast("string"), F.lit(name))

    return F.when(
        seconds.isNotNull(),
        F.concat_ws(
            " ",
            units(seconds / 86400, " d"),
            units(seconds % 86400 / 3600, " h"),
            units(seconds % 3600 / 60, " min"),
        ),
    )


def freshness_class(loaded_at: Column, seconds: Column) -> Column:
    return (
        F.when(loaded_at.isNull(), "no_data")
        .when(seconds <= FRESH_SECONDS, "fresh")
        .when(seconds <= WARNING_SECONDS, "warning")
        .otherwise("stale")
    )


def deviation_pct(latest: Column, average: Column) -> Column:
    """Deviation of the latest value from an average in percent, two decimals."""
    gap = (latest - average).cast("decimal(24,2)")
    share = (gap * F.lit(100) / F.nullif(average, F.lit(0).cast("decimal(18,2)")))
    return F.round(share, 2).cast("decimal(18,2)")


def volume_class(latest: Column, loads: Column, average: Column) -> Column:
    """Ordered volume rules: baseline problems first, then drops, then spikes."""

    def share(text: str) -> Column:
        return average * F.lit(text).cast("decimal(3,1)")

    return (
        F.when(loads.isNull(), "no_baseline")
        .when(loads < 3, "weak_baseline")
        .when(average == 0, "invalid_baseline")
        .when(latest <= share("0.2"), "anomaly")
        .when(latest <= share("0.6"), "warning")
        .when(latest >= share("2.5"), "warning")
        .otherwise("normal")
    )

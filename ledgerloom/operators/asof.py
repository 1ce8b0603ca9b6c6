"""As-of joins against slowly changing values such as exchange rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import MAX_BROADCAST_ROWS, is_small, lookup_join, salted

INTERVAL_BUCKET_DAYS = 32
ROWS_PER_SALT = 2_000_000
STRATEGIES = ("auto", "interval", "dense", "union")


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """The values of the row that comes last in ``order`` for each key.

    A partial aggregate runs before the shuffle, so a hot key is no hot task.
    """
    if len(values) == 1 and len(order) == 1:
        # Without structs the aggregate can hash instead of sort.
        return df.groupBy(*keys).agg(F.max_by(values[0], order[0]).alias(values[0]))
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *(F.col(f"_last.{v}").alias(v) for v in values))


def rate_points(rates: DataFrame, tie_break: str = "raw_id") -> DataFrame:
    """One rate per base currency and date; the highest ``tie_break`` wins a tie."""
    dated = rates.filter(F.col("rate_date").isNotNull() & F.col("base_currency").isNotNull())
    return latest_per_key(dated, ["base_currency", "rate_date"], [tie_break], ["rate"])


def validity_intervals(points: DataFrame, by: list[str], time: str) -> DataFrame:
    """Each point with ``valid_to``: the time of the next one, NULL for the last."""
    following = F.lead(time).over(Window.partitionBy(*by).orderBy(time))
    return points.withColumn("valid_to", following)


def day_span(points: DataFrame, day: str) -> tuple[date | None, date | None]:
    """First and last day of a relation (both None if it is empty)."""
    return tuple(points.agg(F.min(day), F.max(day)).first())


def dense_days(points: DataFrame, by: list[str], day: str, last_day: date | None) -> DataFrame:
    """Every day of every key up to ``last_day``, each with the value in force."""
    spans = validity_intervals(points, by, day)
    until = F.coalesce(F.date_sub("valid_to", 1), F.lit(last_day).cast("date"))
    days = F.explode(F.sequence(F.col(day), until))
    return spans.withColumn("_day", days).drop(day, "valid_to").withColumnRenamed("_day", day)


def clamp_day(time: str, last_day: date | None) -> Column:
    """The day to look up: after the last change of any value every day is like the last one.

    A NULL time stays NULL, which least() alone would skip.
    """
    day = F.col(time).cast("date")
    return F.when(day.isNotNull(), F.least(day, F.lit(last_day).cast("date")))


def rate_board(points: DataFrame, last_day: date | None) -> DataFrame:
    """One row per day up to ``last_day`` with a map of all rates in force.

    A map has at most one entry per currency.
    """
    days = dense_days(points, ["base_currency"], "rate_date", last_day)
    entries = F.collect_list(F.struct("base_currency", "rate"))
    return days.groupBy("rate_date").agg(F.map_from_entries(entries).alias("rates"))


def _day_bucket(time: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(time.cast("date")) / bucket_days)


def _bucketed_spans(points, by, right_time, values, bucket_days):
    """Validity intervals, one row per time bucket they touch, and the last bucket."""
    first_bucket = _day_bucket(F.col(right_time), bucket_days)
    last = points.agg(F.max(first_bucket)).first()[0]
    # The last interval is open: it ends in the last bucket, where later rows are looked up.
    last_bucket = F.coalesce(_day_bucket(F.col("valid_to"), bucket_days), F.lit(last))
    return validity_intervals(points, by, right_time).select(
        *(F.col(k).alias(f"_r_{k}") for k in by),
        F.col(right_time).alias("_from"), F.col("valid_to").alias("_to"), *values,
        F.explode(F.sequence(first_bucket, last_bucket)).alias("_r_bucket"),
    ), last


def _interval(left, spans, last, by, left_time, right_type, values, bucket_days, small):
    """Range join with an equality on a time bucket, so a row meets the few intervals of its
    key and bucket and not all of its key. Many intervals are joined by a shuffle on key, bucket
    and salt, so that neither a hot key nor a busy bucket is one task."""
    at = F.col(left_time).cast(right_type)
    bucket = F.least(_day_bucket(F.col(left_time), bucket_days), F.lit(last))
    rows = left
    if small:
        spans = F.broadcast(spans)
        match = bucket == F.col("_r_bucket")
    else:
        rows, spans = salted(left, spans)
        # The optimizer's estimate leaves out the copies per bucket and salt and would broadcast them.
        spans = spans.withColumnRenamed("_salt", "_r_salt").hint("merge")
        match = (bucket == F.col("_r_bucket")) & (F.col("_salt") == F.col("_r_salt"))
    match = match & (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    for k in by:
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    return rows.join(spans, match, "left").select(*left.columns, *values)


def _dense(left, points, by, left_time, right_time, values, max_broadcast_rows):
    _, last_day = day_span(points, right_time)
    days = dense_days(points, by, right_time, last_day).select(
        *by, F.col(right_time).alias("_day"), *values
    )
    dated = left.withColumn("_day", clamp_day(left_time, last_day))
    joined = lookup_join(dated, days, [*by, "_day"], max_broadcast_rows=max_broadcast_rows)
    return joined.select(*left.columns, *values)


def _union(left, points, by, left_time, right_time, values, bucket_days, salts):
    """Both sides in one stream of events per key, time bucket and salt.

    Each bucket starts with the value carried in from the buckets before it, so buckets are
    independent; the salt spreads the left rows of a hot key or a hot bucket.
    """
    time_type = points.schema[right_time].dataType

    def bucket(time):
        return _day_bucket(F.col(time), bucket_days)

    held = F.struct(*values).alias("_held")
    right = points.select(*by, F.col(right_time).alias("_time"), held,
                          bucket(right_time).alias("_bucket"))
    keyed = left.withColumn("_time", F.col(left_time).cast(time_type)) \
        .withColumn("_bucket", bucket(left_time))

    # Value in force when a bucket starts, for each bucket that left rows fall into.
    needed = keyed.select(*by, "_bucket").distinct().filter(F.col("_bucket").isNotNull())
    closing = right.groupBy(*by, "_bucket").agg(F.max_by("_held", "_time").alias("_close"))
    marks = closing.withColumn("_need", F.lit(False)).unionByName(
        needed.withColumn("_need", F.lit(True)), allowMissingColumns=True
    )
    before = Window.partitionBy(*by).orderBy("_bucket").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("_held", F.last("_close", ignorenulls=True).over(before)) \
        .filter("_need").select(*by, "_bucket", "_held").filter(F.col("_held").isNotNull())

    rows, right_rows = salted(keyed, right.unionByName(carried, allowMissingColumns=True), salts)
    payload = F.struct(*left.columns)
    events = (
        rows.select(*by, "_bucket", "_salt", "_time", payload.alias("_row"), F.lit(1).alias("_side"))
        .unionByName(
            right_rows.select(*by, "_bucket", "_salt", "_time", "_held", F.lit(0).alias("_side")),
            allowMissingColumns=True,
        )
    )
    so_far = (
        Window.partitionBy(*by, "_bucket", "_salt")
        # The carried value has no time of its own and comes first; a value counts from its
        # own instant on.
        .orderBy(F.col("_time").asc_nulls_first(), "_side")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # A NULL key or a NULL time matches nothing.
    usable = F.col("_time").isNotNull()
    for k in by:
        usable = usable & F.col(k).isNotNull()
    found = F.when(usable, F.last("_held", ignorenulls=True).over(so_far))
    return events.withColumn("_found", found).filter("_side = 1").select(
        "_row.*", *(F.col(f"_found.{v}").alias(v) for v in values)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_time: str,
    right_time: str,
    values: list[str],
    strategy: str = "auto",
    tie_break: str | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    bucket_days: int = 366,
    salts: int | None = None,
) -> DataFrame:
    """Left join each row to the last right row of its key at or before its time.

    - ``dense``: the right side, kept by date, is filled to one row per key and day and
      joined on equality.
    - ``interval``: the right side becomes validity intervals, cut at time buckets; few of
      them are broadcast, many are joined by a shuffle.
    - ``union``: for a right side that is large or kept by timestamp; both sides are sorted
      together within key, time bucket and salt. The number of salts follows from that of the
      left rows unless given.
    - ``auto``: ``dense`` for dates, else ``interval`` if the right side is small, else
      ``union``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    dated = right.filter(F.col(right_time).isNotNull())
    points = latest_per_key(dated, [*by, right_time], [tie_break or right_time], values)
    by_date = points.schema[right_time].dataType.typeName() == "date"
    if strategy == "dense" or (strategy == "auto" and by_date):
        if not by_date:
            raise ValueError("the dense strategy needs a right side kept by date")
        return _dense(left, points, by, left_time, right_time, values, max_broadcast_rows)
    if strategy == "interval" or (strategy == "auto" and is_small(points, max_broadcast_rows)):
        spans, last = _bucketed_spans(points, by, right_time, values, INTERVAL_BUCKET_DAYS)
        small = is_small(spans, max_broadcast_rows)
        if small or strategy == "interval":
            right_type = points.schema[right_time].dataType
            return _interval(left, spans, last, by, left_time, right_type, values,
                             INTERVAL_BUCKET_DAYS, small)
    if salts is None:
        salts = max(1, -(-left.count() // ROWS_PER_SALT))
    return _union(left, points, by, left_time, right_time, values, bucket_days, salts)

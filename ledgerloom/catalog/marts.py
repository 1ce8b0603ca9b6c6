"""Registered marts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog import derived, oracle
from ledgerloom.catalog.derived import Tables
from ledgerloom.catalog.registry import query
from ledgerloom.plans import dashboards, incremental, marts, monitoring
from ledgerloom.plans.core import core_rates
from ledgerloom.session import shared_dir

EVENTS_AS_OF = f"TIMESTAMP '{derived.EVENTS_AS_OF}'"


def fact_mart(t: Tables, ledger: DataFrame | None = None, numeric: str = "decimal", **options):
    return marts.fact_mart(
        t.stored_ledger() if ledger is None else ledger, t.stored_rates(), t.recurring_tag,
        t.reserve_tag, numeric=numeric, **options,
    )


def balance_mart(t: Tables, ledger: DataFrame | None = None, numeric: str = "decimal", **options):
    return marts.balance_mart(
        t.stored_ledger() if ledger is None else ledger, t.stored_rates(), t.as_of,
        numeric=numeric, **options,
    )


query("stg_transactions", "SELECT * FROM staged")(lambda t: t.staged())
query("stg_rates", "SELECT * FROM staged_rates")(lambda t: t.staged_rates())
query("core_transactions", "SELECT * FROM ledger")(lambda t: t.ledger())
query("core_rates", "SELECT * FROM staged_rates")(
    lambda t: t.stored(core_rates(t.staged_rates()), "rates")
)
query("fact_mart", "SELECT * FROM facts")(fact_mart)
query("balance_mart", "SELECT * FROM balances")(balance_mart)


@query("fact_mart_masked", "SELECT * FROM masked_facts")
def fact_mart_masked(t: Tables) -> DataFrame:
    return marts.fact_mart_masked(
        t.stored_ledger(), t.stored_rates(), t.recurring_tag, t.reserve_tag, t.dim_accounts,
        t.dim_accounts_demo, t.category_mask,
    )


@query("balance_mart_masked", "SELECT * FROM masked_balances")
def balance_mart_masked(t: Tables) -> DataFrame:
    return marts.balance_mart_masked(
        t.stored_ledger(), t.stored_rates(), t.dim_accounts, t.dim_accounts_demo,
        t.category_mask, t.as_of,
    )


def _earlier(t: Tables):
    """What a first build saw: half of the bookings of late years, and rates before some were corrected."""
    seen = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    ledger = t.stored_ledger()
    rates = t.stored_rates()
    wrong = F.when(F.expr("raw_id % 50 = 3"), F.col("rate") + 1).otherwise(F.col("rate")).cast("decimal(24,12)")
    part = ledger.filter(seen | (F.col("transaction_ts") < "1997-01-01") | F.col("transaction_ts").isNull())
    return ledger, rates, part, rates.withColumn("rate", wrong)


@query("fact_mart_refreshed", "SELECT * FROM facts")
def fact_mart_refreshed(t: Tables) -> DataFrame:
    """Built from earlier bookings and rates, then brought up to date: equal to the full mart."""
    path = shared_dir(t.spark, "facts")
    ledger, rates, part, wrong = _earlier(t)
    for rows, points in ((part, wrong), (part, rates), (ledger, rates), (ledger, rates)):
        incremental.refresh_fact_mart(t.spark, path, rows, points, t.recurring_tag, t.reserve_tag)
    schema = marts.fact_mart(ledger, rates, t.recurring_tag, t.reserve_tag).schema
    return incremental.read_fact_mart(t.spark, path, schema)


@query("balance_mart_refreshed", "SELECT * FROM balances")
def balance_mart_refreshed(t: Tables) -> DataFrame:
    """Built on an earlier day from earlier bookings and rates, then brought up to date."""
    path = shared_dir(t.spark, "balances")
    ledger, rates, part, wrong = _earlier(t)
    today = date.fromisoformat(derived.AS_OF)
    for rows, points, day in ((part, wrong, today - timedelta(100)), (part, rates, today), (ledger, rates, today),
                              (ledger, rates, today)):
        incremental.refresh_balance_mart(t.spark, path, rows, points, day)
    return incremental.read_balance_mart(t.spark, path, marts.balance_mart(ledger, rates, t.as_of).schema)


_SECONDS = f"CAST(round((epoch_us({EVENTS_AS_OF}) - epoch_us(finished_at)) / 1000000) AS BIGINT)"


@query("freshness", f"""
    SELECT ingestion_id, source_system, source_object, raw_table, s3_bucket, s3_key,
           file_size_bytes, rows_loaded, discovered_at, started_at,
           finished_at AS last_successful_load_at, {EVENTS_AS_OF} AS checked_at,
           {_SECONDS} AS seconds_since_last_load,
           CASE WHEN {_SECONDS} IS NOT NULL THEN
               {_SECONDS} // 86400 || ' d ' || {_SECONDS} % 86400 // 3600 || ' h '
               || {_SECONDS} % 3600 // 60 || ' min' END AS time_since_last_load_text,
           CASE WHEN finished_at IS NULL THEN 'no_data' WHEN {_SECONDS} <= 259200 THEN 'fresh'
                WHEN {_SECONDS} <= 604800 THEN 'warning' ELSE 'stale' END AS freshness_status
    FROM load_registry WHERE status = 'loaded'
    ORDER BY finished_at DESC NULLS FIRST, ingestion_id DESC LIMIT 1
""")
def freshness(t: Tables) -> DataFrame:
    return monitoring.freshness(t.load_registry, F.lit(derived.EVENTS_AS_OF).cast("timestamp"))


@query("freshness_no_end", f"""
    SELECT ingestion_id, source_object, finished_at AS last_successful_load_at,
           {_SECONDS} AS seconds_since_last_load,
           CASE WHEN {_SECONDS} IS NOT NULL THEN
               {_SECONDS} // 86400 || ' d ' || {_SECONDS} % 86400 // 3600 || ' h '
               || {_SECONDS} % 3600 // 60 || ' min' END AS time_since_last_load_text,
           CASE WHEN finished_at IS NULL THEN 'no_data' WHEN {_SECONDS} <= 259200 THEN 'fresh'
                WHEN {_SECONDS} <= 604800 THEN 'warning' ELSE 'stale' END AS freshness_status
    FROM load_registry WHERE status = 'loaded'
    ORDER BY finished_at DESC NULLS FIRST, ingestion_id DESC LIMIT 1
""")
def freshness_no_end(t: Tables) -> DataFrame:
    return monitoring.freshness(
        t.load_registry, F.lit(derived.EVENTS_AS_OF).cast("timestamp")
    ).select("ingestion_id", "source_object", "last_successful_load_at",
             "seconds_since_last_load", "time_since_last_load_text", "freshness_status")


RANKED = """
    SELECT *, row_number() OVER (
        PARTITION BY source_system, source_object, raw_table
        ORDER BY finished_at DESC NULLS FIRST, ingestion_id DESC) AS load_rank
    FROM load_registry WHERE status = 'loaded'
"""
BASELINE = f"""
    SELECT source_system, source_object, raw_table, count(*) AS baseline_load_count,
           CAST(round(CAST(sum(rows_loaded) AS DOUBLE) / count(*), 2) AS DECIMAL(18,2))
               AS avg_rows_loaded,
           min(rows_loaded) AS min_rows_loaded, max(rows_loaded) AS max_rows_loaded
    FROM ({RANKED}) WHERE load_rank BETWEEN 2 AND 8 GROUP BY ALL
"""
# Percent in integers: cents of the gap over cents of the average, rounded half up.
_GAP = "CAST((rows_loaded - avg_rows_loaded) * 100 AS BIGINT)"
_AVG = "nullif(CAST(avg_rows_loaded * 100 AS BIGINT), 0)"
DEVIATION = f"""CAST(sign({_GAP}) * ((abs({_GAP}) * 20000 + {_AVG}) // (2 * {_AVG}))
    AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2))"""
VOLUME = """CASE WHEN baseline_load_count IS NULL THEN 'no_baseline'
    WHEN baseline_load_count < 3 THEN 'weak_baseline'
    WHEN avg_rows_loaded = 0 THEN 'invalid_baseline'
    WHEN rows_loaded * 10 <= avg_rows_loaded * 2 THEN 'anomaly'
    WHEN rows_loaded * 10 <= avg_rows_loaded * 6 THEN 'warning'
    WHEN rows_loaded * 10 >= avg_rows_loaded * 25 THEN 'warning' ELSE 'normal' END"""


@query("volume_monitoring", f"""
    SELECT ingestion_id, source_system, source_object, raw_table, s3_bucket, s3_key,
           file_size_bytes, finished_at AS latest_load_at, rows_loaded AS latest_rows_loaded,
           baseline_load_count, avg_rows_loaded, min_rows_loaded, max_rows_loaded,
           CAST({DEVIATION} AS DECIMAL(18,2)) AS deviation_pct, {VOLUME} AS volume_status,
           {EVENTS_AS_OF} AS checked_at
    FROM (SELECT * FROM ({RANKED}) WHERE load_rank = 1)
    LEFT JOIN ({BASELINE}) USING (source_system, source_object, raw_table)
""")
def volume_monitoring(t: Tables) -> DataFrame:
    return monitoring.volume_monitoring(
        t.load_registry, F.lit(derived.EVENTS_AS_OF).cast("timestamp")
    )


# In the pivot currency a conversion is one exact product, so sums can be compared exactly.
_IN_RUB = f"""
    SELECT f.*, CASE WHEN f.currency = 'RUB' THEN CAST(f.amount_abs AS DECIMAL(38,6))
        ELSE CAST(f.amount_abs AS DECIMAL(24,2)) * CAST(o.exact_rate AS DECIMAL(14,4)) END AS rub,
        {oracle.period('f.transaction_date', "'Month'")} AS period
    FROM classified AS f
    ASOF LEFT JOIN rate_points AS o ON o.base_currency = f.currency
        AND o.rate_date <= CAST(f.transaction_date AS DATE)
"""


@query("spend_by_period", f"""
    SELECT period, parent_category, expense_type, account_type,
           CAST(sum(rub) AS DECIMAL(38,6)) AS spend, count(*) AS transactions
    FROM ({_IN_RUB}) WHERE transaction_type = 'Expense' GROUP BY ALL
""")
def spend_by_period(t: Tables) -> DataFrame:
    return dashboards.spend_by_period(fact_mart(t, grains=["Month"], targets=["RUB"]), "Month", "RUB")


@query("income_by_period", f"""
    SELECT period, parent_category, account_type,
           CAST(sum(rub) AS DECIMAL(38,6)) AS income, count(*) AS transactions
    FROM ({_IN_RUB}) WHERE transaction_type = 'Income' GROUP BY ALL
""")
def income_by_period(t: Tables) -> DataFrame:
    return dashboards.income_by_period(fact_mart(t, grains=["Month"], targets=["RUB"]), "Month", "RUB")


@query("balance_over_time", """
    SELECT period, account_type, count(*) AS accounts,
           CAST(sum(CASE WHEN f.currency = 'RUB' THEN CAST(f.balance AS DECIMAL(38,6))
               ELSE CAST(f.balance AS DECIMAL(24,2)) * CAST(o.exact_rate AS DECIMAL(14,4)) END)
               AS DECIMAL(38,6)) AS balance
    FROM snapshots AS f
    ASOF LEFT JOIN rate_points AS o
        ON o.base_currency = f.currency AND o.rate_date <= f.period_end
    WHERE period_grain = 'Week' GROUP BY period, account_type
""")
def balance_over_time(t: Tables) -> DataFrame:
    return dashboards.balance_over_time(balance_mart(t, grains=["Week"], targets=["RUB"]), "Week", "RUB")

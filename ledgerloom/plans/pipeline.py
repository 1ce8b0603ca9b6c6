"""Load new files and build all layers: what a scheduled run calls."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import parse_date_by_source
from ledgerloom.plans import marts, monitoring
from ledgerloom.plans.core import core_rates, core_transactions
from ledgerloom.plans.staging import stg_rates, stg_transactions
from ledgerloom.quality import suite
from ledgerloom.operators.joins import lookup_join
from ledgerloom.schemas import FILE_REGISTRY, RATE_PAYLOAD, RATE_STATE, RAW_RATE_TEXT
from ledgerloom.sources import exports, rates, registry, sinks


def load_latest_export(
    spark: SparkSession, inbox: str, raw_path: str, registry_path: str,
    source: tuple[str, str, str], as_of: Column, loaded_by: str = "ledgerloom",
    pattern: str = "*.csv", **options,
) -> str:
    """Land the newest export unless it is loaded already: ``loaded`` or ``skipped``.

    The registry says ``processing`` before rows are written and ``loaded`` after; an error
    leaves ``failed`` with its text and is raised again, and the file is tried again next time.
    """
    path = exports.latest_file_path(spark, inbox, pattern)
    system, name, table = source
    entries, version = sinks.read_version(spark, registry_path, FILE_REGISTRY)
    file = exports.file_metadata(spark, path).select(
        F.lit(inbox).alias("s3_bucket"), F.lit(path).alias("s3_key"), "file_size_bytes",
        "file_checksum", F.lit(system).alias("source_system"),
        F.lit(name).alias("source_object"), F.lit(table).alias("raw_table"),
    )
    if registry.new_files(file, entries).isEmpty():
        return "skipped"

    def move(entries: DataFrame, version: int, status: str, rows=None, error=None):
        event = spark.range(1).select(
            F.lit(ingestion_id).alias("ingestion_id"), F.lit(status).alias("status"),
            as_of.cast("timestamp").alias("event_ts"), F.lit(rows).cast("long").alias("rows_loaded"),
            F.lit(error).cast("string").alias("error_message"),
        )
        moved = registry.registry_transition(entries, event)
        sinks.write_version(moved, registry_path, version + 1)
        return sinks.read_version(spark, registry_path, FILE_REGISTRY)

    entries = registry.register_files(file, entries, as_of)
    ingestion_id = entries.filter((F.col("s3_bucket") == inbox) & (F.col("s3_key") == path)) \
        .first().ingestion_id
    entries, version = move(entries, version, "processing")
    try:
        rows = exports.read_ledger_export(spark, path, **options)
        landed = exports.with_provenance(rows, F.lit(ingestion_id), as_of, loaded_by, F.lit(path))
        count = exports.append_raw(landed, raw_path)
    except Exception as error:
        move(entries, version, "failed", error=str(error))
        raise
    move(entries, version, "loaded", rows=count)
    return "loaded"


def load_exchange_rates(
    spark: SparkSession, documents: str, catalog_path: str, table_path: str, state_path: str,
    requested: DataFrame, ledger_dates: DataFrame, as_of: Column, loaded_by: str = "ledgerloom",
    source: str = "cbr",
) -> str:
    """Merge landed rate documents of all currencies that are due: ``loaded`` or ``skipped``.

    ``requested`` has source and currency_code. Only dates inside a currency's request window
    count; a currency asked for the first time must have some.
    """
    state, state_version = sinks.read_version(spark, state_path, RATE_STATE)
    _, table_version = rates.read_rate_table(spark, table_path)
    due = rates.refresh_due(requested, state, as_of)
    if due.isEmpty():
        return "skipped"
    catalog = rates.read_currency_catalog(spark, catalog_path)
    rates.require_known(due, catalog)
    end = as_of.cast("date")
    window = rates.request_window(due, ledger_dates, end).select(
        "source", F.col("currency_code").alias("base_currency"), "start_date", "end_date"
    )
    day = parse_date_by_source(F.col("rate_date"), F.col("source"))
    fetched = (
        rates.read_rates_xml(spark, documents, catalog, source).withColumn("_day", day)
    )
    fetched = (
        lookup_join(fetched, window, ["source", "base_currency"], "inner")
        .filter(F.col("_day").between(F.col("start_date"), F.col("end_date")))
    )
    typed = fetched.select("source", "base_currency", F.col("_day").alias("rate_date"))
    rates.refuse(rates.empty_first_loads(due, typed), "no rates for new currencies")
    # Of several documents with one date the one written last counts.
    changed = rates.merge_rates(spark, table_path, fetched.select(*RAW_RATE_TEXT, "_modified"),
                                ["_modified", *RATE_PAYLOAD], table_version + 1, as_of, loaded_by)
    moved = rates.rate_state(state, due, typed, changed, end, as_of)
    sinks.write_version(moved, state_path, state_version + 1)
    return "skipped" if changed.isEmpty() else "loaded"


CHECK_KEY = ["target_name", "invocation_id", "unique_id"]


def log_checks(
    results: DataFrame, path: str, target: str, invocation: str, as_of: Column,
    seconds: float | None = None,
) -> None:
    """Keep check results: a history where a repeated invocation adds nothing, and the
    current results of each target, which replace its earlier ones."""
    spark = results.sparkSession
    logged = suite.log_results(results, target, invocation, as_of, seconds).persist()
    history = sinks.read_table(spark, f"{path}/history", logged.schema)
    sinks.insert_ignore(history, logged, CHECK_KEY, ["logged_at"]) \
        .write.mode("append").partitionBy("target_name").parquet(f"{path}/history")
    current = logged.withColumnRenamed("logged_at", "updated_at")
    sinks.write_partitions(current, f"{path}/current", ["target_name"])
    logged.unpersist()


@dataclass
class Reference:
    """Reference data the layers need; the masked layer only with the last two."""

    accounts: DataFrame
    recurring: DataFrame
    reserve_funded: DataFrame
    accounts_demo: DataFrame | None = None
    masks: DataFrame | None = None


# Every read of a mart names one grain and one currency.
_MART_PARTITIONS = ["period_grain", "target_currency"]


def build_layers(
    raw: DataFrame, entries: DataFrame, raw_rates: DataFrame, reference: Reference,
    source: tuple[str, str, str], as_of: Column, path: str, prefix: str = "",
    stop_on_error: bool = True, target: str = "default", invocation: str | None = None,
) -> dict[str, DataFrame]:
    """Staging views, core and mart tables, monitoring and check results, by name.

    Each table is written once and read by the layers above it. Core checks run before the
    marts are built; one that fails with severity error stops the build. Results are kept under
    ``path/checks`` for this ``invocation`` before a failure is raised.
    """
    layers: dict[str, DataFrame] = {}
    invocation = invocation or uuid.uuid4().hex
    so_far: list[DataFrame] = []

    def keep(name: str, df: DataFrame, kind: str = "table", by: list[str] = ()) -> DataFrame:
        layers[name] = sinks.materialize(df, prefix + name, kind, f"{path}/{name}", by)
        return layers[name]

    def check(run: suite.Suite) -> None:
        start = time.monotonic()
        results = run.run().persist()
        results.count()
        so_far.append(results)
        # All results of this invocation are the target's current ones.
        log_checks(reduce(DataFrame.unionByName, so_far), f"{path}/checks", target, invocation,
                   as_of, time.monotonic() - start)
        if stop_on_error:
            suite.enforce(results)

    staged = keep("stg_fact_transaction", stg_transactions(raw, entries, *source), "view")
    staged_rates = keep("stg_exchange_rate", stg_rates(raw_rates), "view")
    ledger = keep("core_fact_transaction", core_transactions(staged, reference.accounts, as_of))
    rate_table = keep("core_exchange_rate", core_rates(staged_rates))

    run = suite.staging_checks(suite.Suite(), staged, staged_rates)
    run = suite.core_checks(run, ledger, rate_table, reference.accounts)
    run = suite.seed_checks(run, reference.accounts, {
        "recurring_expense_tag": reference.recurring,
        "reserve_funded_expense_tag": reference.reserve_funded,
    }, raw)
    if reference.accounts_demo is not None:
        run = suite.seed_checks(run, reference.accounts_demo, {}, raw, "seed_dim_accounts_demo")
    check(run)

    day = as_of.cast("date")
    tags = (reference.recurring, reference.reserve_funded)
    facts = keep("dm_fact_transaction", marts.fact_mart(ledger, rate_table, *tags),
                 by=_MART_PARTITIONS)
    balances = keep("dm_account_balance", marts.balance_mart(ledger, rate_table, day),
                    by=_MART_PARTITIONS)
    check(suite.mart_checks(suite.Suite(), facts, balances, rate_table))
    if reference.masks is not None:
        masked = (reference.accounts, reference.accounts_demo, reference.masks)
        check(suite.mask_checks(suite.Suite(), ledger, reference.masks))
        facts = keep("dm_demo_fact_transaction", marts.fact_mart_masked(
            ledger, rate_table, *tags, *masked), by=_MART_PARTITIONS)
        balances = keep("dm_demo_account_balance", marts.balance_mart_masked(
            ledger, rate_table, *masked, day), by=_MART_PARTITIONS)
        check(suite.mart_checks(suite.Suite(), facts, balances, rate_table, layer="dm_demo"))
    freshness = keep("infra_data_quality_freshness", monitoring.freshness(entries, as_of), "view")
    volume = keep("infra_data_volume_monitoring", monitoring.volume_monitoring(entries, as_of))
    check(suite.monitoring_checks(suite.Suite(), freshness, volume))
    keep("infra_check_results", reduce(DataFrame.unionByName, so_far))
    for results in so_far:
        results.unpersist()
    return layers


OUTCOMES = ("loaded", "skipped")


def run_all(
    load_exports: Callable[[], str], load_rates: Callable[[], str],
    build: Callable[[], dict[str, DataFrame]],
) -> dict[str, DataFrame] | None:
    """One whole run: exports, then rates (which ask for the ledger's dates), then the layers,
    unless neither brought anything new. A load that ends in another word is an error."""
    outcomes = []
    for load in (load_exports, load_rates):
        outcomes.append(load())
        if outcomes[-1] not in OUTCOMES:
            raise ValueError(f"a load ends as one of {OUTCOMES}, not {outcomes[-1]!r}")
    return None if all(o == "skipped" for o in outcomes) else build()

"""Rate documents and the state of rate ingestion."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_text, normalize_code, parse_date_by_source
from ledgerloom.operators.joins import MAX_BROADCAST_ROWS, is_small, lookup_join
from ledgerloom.schemas import (
    FX_INITIAL_LOOKBACK_DAYS, FX_REFRESH_MINUTES, FX_RELOAD_LOOKBACK_DAYS, RATE_DATE_FORMATS, RATE_KEY,
    RATE_PAYLOAD, RATE_TABLE, REFERENCE_CURRENCIES,
)
from ledgerloom.sources.partitions import merge_partitions, read_partitions

RECORD_SCHEMA = "_Date STRING, Nominal STRING, Value STRING"
VALUTE_SCHEMA = "_ID STRING, CharCode STRING"


def rate_rows(
    records: DataFrame, catalog: DataFrame, source: str = "cbr",
    reference_currencies: dict[str, str] = REFERENCE_CURRENCIES,
) -> DataFrame:
    """Text rate rows from parsed records of one currency column each.

    Records without nominal or value are skipped. A column ``_modified`` is kept.
    """
    kept = [c for c in records.columns if c == "_modified"]
    rows = records.select(
        F.btrim("_Date").alias("rate_date"),
        normalize_code(F.col("currency")).alias("base_currency"),
        clean_text(F.col("Nominal")).alias("base_amount"),
        clean_text(F.col("Value")).alias("quote_amount"),
        *kept,
    ).filter(F.col("base_amount").isNotNull() & F.col("quote_amount").isNotNull())
    keys = catalog.select(
        F.col("currency_code").alias("base_currency"), F.col("currency_id").alias("source_rate_key")
    )
    return lookup_join(rows, keys, ["base_currency"], "inner").select(
        F.lit(source).alias("source"), "source_rate_key", "rate_date", "base_currency",
        "base_amount", F.lit(reference_currencies[source]).alias("quote_currency"), "quote_amount",
        *kept,
    )


def read_rates_xml(
    spark: SparkSession, path: str, catalog: DataFrame, source: str = "cbr"
) -> DataFrame:
    """Text rate rows from XML documents kept in one folder ``currency=XXX`` per currency, with the
    time each row's document was written (``_modified``)."""
    records = spark.read.format("xml").option("rowTag", "Record").schema(
        RECORD_SCHEMA + ", currency STRING"
    ).load(path).select("*", F.col("_metadata.file_modification_time").alias("_modified"))
    return rate_rows(records, catalog, source)


def read_currency_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Currency code to id from a catalog document; blank entries are dropped."""
    entries = spark.read.format("xml").option("rowTag", "Valute").schema(VALUTE_SCHEMA).load(path)
    return entries.select(
        normalize_code(F.col("CharCode")).alias("currency_code"),
        clean_text(F.col("_ID")).alias("currency_id"),
    ).dropna()


def unknown_currencies(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requested currency codes that the catalog does not have."""
    return lookup_join(requested.select("currency_code").distinct(), catalog, ["currency_code"],
                       "left_anti")


def refuse(currencies: DataFrame, problem: str, named: int = 10) -> None:
    """Fail if there are any currencies, naming the first few and saying how many there are."""
    first = [r.currency_code for r in currencies.orderBy("currency_code").limit(named + 1).collect()]
    if first:
        more = "" if len(first) <= named else f" and others, {currencies.count()} in all"
        raise ValueError(f"{problem}: " + ", ".join(first[:named]) + more)


def require_known(requested: DataFrame, catalog: DataFrame) -> None:
    """Fail if the catalog lacks a requested currency."""
    refuse(unknown_currencies(requested, catalog), "currencies not in the catalog")


def upsert_changed(
    existing: DataFrame,
    incoming: DataFrame,
    order: list[str],
    keys: list[str] = RATE_KEY,
    payload: list[str] = RATE_PAYLOAD,
    touched: dict[str, Column] | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Merge incoming rows by key; ``change`` says insert, update or none for every row.

    A row is updated only where its payload differs (NULL equals NULL); ``touched`` columns
    are set on inserted and updated rows. Of several incoming rows with one key the last in
    ``order`` counts. Keys must not be NULL. A small incoming side is broadcast, so that the
    table it is merged into is not shuffled.
    """
    touched = touched or {}
    fresh = incoming.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("_new")
    )
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new.{c}")) for c in payload])
    known = F.col("_old")
    change = F.when(known & F.col("_new").isNotNull() & differs, "update") \
        .when(~known, "insert").otherwise("none")
    marked = existing.withColumn("_old", F.lit(True))
    if is_small(fresh, max_broadcast_rows):
        kept = marked.join(F.broadcast(fresh), keys, "left")
        # Keys already there, found without shuffling the existing rows.
        there = existing.join(F.broadcast(fresh.select(*keys)), keys, "left_semi") \
            .select(*keys).distinct()
        added = fresh.join(F.broadcast(there), keys, "left_anti")
        both = kept.unionByName(added, allowMissingColumns=True)
    else:
        both = marked.join(fresh, keys, "full_outer")
    both = both.withColumn("_old", F.coalesce("_old", F.lit(False))).withColumn("change", change)
    taken = F.col("change") != "none"
    values = {c: F.col(f"_new.{c}") for c in payload} | touched
    return both.select(*(
        F.when(taken, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in existing.columns
    ), "change")


#: Rates are kept in one partition a year.
RATE_PARTITION = "rate_year"


def rate_year(
    date: Column, source: Column, formats: dict[str, str] = RATE_DATE_FORMATS
) -> Column:
    """Partition of a rate: the year in its date text, or ``undated`` if that does not parse."""
    day = parse_date_by_source(clean_text(date), clean_text(source), formats, strict=False)
    return F.coalesce(F.date_format(day, "yyyy"), F.lit("undated"))


def read_rate_table(spark: SparkSession, path: str, below: int | None = None) -> tuple[DataFrame, int]:
    """The stored rates and the number of their newest write."""
    table, version = read_partitions(spark, path, RATE_TABLE, [RATE_PARTITION], below)
    return table.drop(RATE_PARTITION), version


def merge_rates(
    spark: SparkSession, path: str, incoming: DataFrame, order: list[str], version: int, as_of: Column,
    loaded_by: str, max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Merge text rate rows into the stored table as write ``version``: only years with a changed rate are
    written anew. The result is the rows inserted or updated."""
    rows = incoming.withColumn(RATE_PARTITION, rate_year(F.col("rate_date"), F.col("source")))
    touched = {
        "raw_id": F.coalesce("raw_id", F.xxhash64(*RATE_KEY)),
        "ingested_at": as_of.cast("timestamp"), "ingested_by": F.lit(loaded_by),
    }

    def merge(present: DataFrame, new: DataFrame) -> DataFrame:
        return upsert_changed(present, new, order, [*RATE_KEY, RATE_PARTITION], touched=touched,
                              max_broadcast_rows=max_broadcast_rows)

    return merge_partitions(spark, path, RATE_TABLE, [RATE_PARTITION], version, rows, merge)


def refresh_due(
    requested: DataFrame, state: DataFrame, as_of: Column, minutes: int = FX_REFRESH_MINUTES,
    reference_currencies: dict[str, str] = REFERENCE_CURRENCIES,
) -> DataFrame:
    """Requested currencies never checked or last checked at least ``minutes`` ago.

    A source's own reference currency is never requested.
    """
    if minutes < 1:
        raise ValueError("rates are refreshed after at least one minute")
    own = F.lit(False)
    for source, currency in reference_currencies.items():
        own = own | ((F.col("source") == source) & (F.col("currency_code") == currency))
    wanted = requested.select("source", "currency_code").distinct().filter(~own)
    checked = F.unix_micros(F.col("last_checked_at").cast("timestamp"))
    age = F.unix_micros(as_of.cast("timestamp")) - checked
    return wanted.join(state, ["source", "currency_code"], "left").filter(
        checked.isNull() | (age >= minutes * 60 * 1_000_000)
    )


def request_window(
    due: DataFrame,
    ledger_dates: DataFrame,
    end_date: Column,
    lookback_days: int = FX_INITIAL_LOOKBACK_DAYS,
    reload_days: int = FX_RELOAD_LOOKBACK_DAYS,
) -> DataFrame:
    """First and last day to request per due currency.

    A currency requested before starts some days before its last request, to pick up late
    corrections; a new one starts before the first ledger date. ``ledger_dates`` has one
    date column ``transaction_date``.
    """
    if lookback_days < 0 or reload_days < 0:
        raise ValueError("days to look back must not be negative")
    first = ledger_dates.agg(F.min("transaction_date")).scalar()
    initial = F.date_sub(F.coalesce(first, end_date), lookback_days)
    start = F.coalesce(F.date_sub("last_requested_through", reload_days), initial)
    return due.select(
        "source", "currency_code",
        F.least(start, end_date).alias("start_date"), end_date.alias("end_date"),
    )


def rate_state(
    state: DataFrame, due: DataFrame, fetched: DataFrame, changed: DataFrame, end_date: Column,
    as_of: Column,
) -> DataFrame:
    """State after a load: due currencies are moved on, the others stay as they are.

    ``fetched`` has the dates read (source, base_currency, rate_date), ``changed`` the rows
    inserted or updated.
    """
    keys = ["source", "currency_code"]
    currency = F.col("base_currency").alias("currency_code")
    dates = fetched.groupBy("source", currency).agg(F.max("rate_date").alias("_fetched"))
    counts = changed.groupBy("source", currency).agg(F.count("*").alias("_rows"))
    loaded = due.select(*keys).join(dates, keys, "left").join(counts, keys, "left") \
        .withColumn("_due", F.lit(True))
    merged = state.join(loaded, keys, "full_outer")
    moved = F.coalesce("_due", F.lit(False))

    def value(new: Column, name: str) -> Column:
        return F.when(moved, new).otherwise(F.col(name)).alias(name)

    return merged.select(
        *keys,
        value(as_of.cast("timestamp"), "last_checked_at"),
        value(end_date, "last_requested_through"),
        value(F.greatest("last_rate_date", "_fetched"), "last_rate_date"),
        value(F.coalesce("_rows", F.lit(0)).cast("long"), "last_rows_affected"),
        value(as_of.cast("timestamp"), "updated_at"),
    )


def empty_first_loads(due: DataFrame, fetched: DataFrame) -> DataFrame:
    """Currencies requested for the first time for which nothing came back: an error."""
    new = due.filter(F.col("last_requested_through").isNull()).select("source", "currency_code")
    seen = fetched.select("source", F.col("base_currency").alias("currency_code")).distinct()
    return new.join(seen, ["source", "currency_code"], "left_anti")

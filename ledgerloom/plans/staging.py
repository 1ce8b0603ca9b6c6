"""Typed staging tables over landed text (M1, M2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import flow_type, is_transfer, unit_rate
from ledgerloom.functions.text import (
    clean_text, normalize_code, parse_date_by_source, parse_decimal, parse_timestamp,
)
from ledgerloom.operators.batches import latest_batch
from ledgerloom.schemas import MONEY, QUOTE, RATE_DATE_FORMATS

_CODES = {"currency", "transfer_currency"}
_LEDGER_TEXT = [
    "source_number", "transaction_date", "account", "amount", "currency", "parent_category",
    "subcategory", "category", "counterparty", "transfer_account", "transfer_amount",
    "transfer_currency", "tags", "place", "note",
]


def _clean(name: str) -> Column:
    return normalize_code(F.col(name)) if name in _CODES else clean_text(F.col(name))


def typed_transactions(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Clean and type raw ledger text.

    Strict mode fails on text that is no date or number. Otherwise such values become NULL
    and the row carries ``bad_columns``, the names of the columns that did not parse.
    """
    cleaned = raw.select(
        "raw_id",
        *(_clean(c).alias(c) for c in _LEDGER_TEXT),
        "ingested_at",
        clean_text(F.col("ingested_by")).alias("ingested_by"),
        clean_text(F.col("source_file")).alias("source_file"),
        "ingestion_id",
    )
    parsed = {
        "transaction_date": parse_timestamp(F.col("transaction_date"), strict=strict),
        "amount": parse_decimal(F.col("amount"), MONEY, strict),
        "transfer_amount": parse_decimal(F.col("transfer_amount"), MONEY, strict),
    }
    typed = cleaned.select(
        *(parsed.get(c, F.col(c)).alias(c) for c in cleaned.columns),
        *([] if strict else [_bad_columns(parsed).alias("bad_columns")]),
    )
    return typed.withColumns({
        "flow_type": flow_type(F.col("amount")),
        "is_transfer": is_transfer(F.col("transfer_account"), F.col("transfer_amount")),
    })


def _bad_columns(parsed: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*(
        F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name))
        for name, value in parsed.items()
    )))


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parse completely, and rows that do not with the names of their bad columns."""
    typed = typed_transactions(raw, strict=False)
    bad = F.size("bad_columns") > 0
    return typed.filter(~bad).drop("bad_columns"), typed.filter(bad)


def stg_transactions(
    raw: DataFrame,
    registry: DataFrame,
    source_system: str,
    source_object: str,
    raw_table: str,
    strict: bool = True,
) -> DataFrame:
    """Typed rows of the newest loaded batch."""
    return typed_transactions(
        latest_batch(raw, registry, source_system, source_object, raw_table), strict
    )


def stg_rates(
    raw: DataFrame, formats: dict[str, str] = RATE_DATE_FORMATS, strict: bool = True
) -> DataFrame:
    """Typed rates of all sources with the price of one unit."""
    cleaned = raw.select(
        "raw_id",
        clean_text(F.col("source")).alias("source"),
        clean_text(F.col("source_rate_key")).alias("source_rate_key"),
        clean_text(F.col("rate_date")).alias("rate_date"),
        normalize_code(F.col("base_currency")).alias("base_currency"),
        clean_text(F.col("base_amount")).alias("base_amount"),
        normalize_code(F.col("quote_currency")).alias("quote_currency"),
        clean_text(F.col("quote_amount")).alias("quote_amount"),
        "ingested_at",
        clean_text(F.col("ingested_by")).alias("ingested_by"),
    )
    typed = cleaned.withColumns({
        "rate_date": parse_date_by_source(F.col("rate_date"), F.col("source"), formats, strict),
        "base_amount": parse_decimal(F.col("base_amount"), QUOTE, strict),
        "quote_amount": parse_decimal(F.col("quote_amount"), QUOTE, strict),
    })
    rate = unit_rate(F.col("quote_amount"), F.col("base_amount")).alias("rate")
    return typed.select(
        "raw_id", "source", "source_rate_key", "rate_date", "base_currency", "base_amount",
        "quote_currency", "quote_amount", rate, "ingested_at", "ingested_by",
    )

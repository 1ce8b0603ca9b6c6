"""The canonical ledger and rate tables (M3, M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import amount_abs, ledger_type
from ledgerloom.functions.hashing import content_hash
from ledgerloom.operators.ledger import enrich_accounts, expand_transfers, union_openings


def core_transactions(
    staged: DataFrame, accounts: DataFrame, as_of: Column, loaded_by: str = "ledgerloom"
) -> DataFrame:
    """Openings, bookings and both legs of transfers with id, type and account flags.

    Apart from the join to the accounts this is one pass over the staged rows.
    """
    rows = staged.select(
        "source_number", F.col("transaction_date").alias("transaction_ts"), "account", "amount",
        "currency", "parent_category", "subcategory", "category", "counterparty",
        "transfer_account", "transfer_amount", "transfer_currency", "tags", "place", "note",
        "flow_type", F.when(F.col("is_transfer"), "transfer_out").alias("transfer_type"),
        "ingested_at", "ingested_by", "source_file", "ingestion_id",
    )
    ledger = expand_transfers(union_openings(rows, accounts, as_of, loaded_by))
    ledger = ledger.withColumns({
        "transaction_id": content_hash(),
        "amount_abs": amount_abs(F.col("amount"), F.col("flow_type")),
        "transaction_type": ledger_type(F.col("flow_type"), F.col("transfer_type")),
    })
    return enrich_accounts(ledger, accounts).select(
        "transaction_id", "source_number", "transaction_ts", "account", "amount", "currency",
        "parent_category", "subcategory", "category", "counterparty", "transfer_account",
        "transfer_amount", "transfer_currency", "tags", "place", "note", "amount_abs",
        "transaction_type", "is_active_account", "is_reserve_account", "is_credit_account",
        "ingested_at", "ingested_by", "source_file", "ingestion_id",
    )


def core_rates(staged: DataFrame) -> DataFrame:
    """Canonical rates."""
    return staged.select(
        "raw_id", "source", "source_rate_key", "rate_date", "base_currency", "quote_currency",
        "base_amount", "quote_amount", "rate", "ingested_at", "ingested_by",
    )

"""Openings, transfer legs and account attributes of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.schemas import MONEY, OPENING_NOTE, OPENING_SOURCE_FILE

# Mirror leg: each side takes the value of the other.
_SWAPPED = {
    "account": "transfer_account",
    "amount": "transfer_amount",
    "transfer_account": "account",
    "transfer_amount": "amount",
    "transfer_currency": "currency",
}


def opening_rows(accounts: DataFrame, like: DataFrame, as_of: Column, loaded_by: str) -> DataFrame:
    """One opening-balance row per account, in the columns of ``like``."""
    known = {
        "transaction_ts": F.col("opening_date").cast("timestamp"),
        "account": F.col("account_name"),
        "amount": F.col("initial_amount").cast(MONEY),
        "currency": F.col("currency"),
        "note": F.lit(OPENING_NOTE),
        "flow_type": F.lit("opening_balance"),
        "ingested_at": as_of.cast("timestamp"),
        "ingested_by": F.lit(loaded_by),
        "source_file": F.lit(OPENING_SOURCE_FILE),
    }
    return accounts.select(*(
        known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
        for field in like.schema
    ))


def union_openings(
    rows: DataFrame, accounts: DataFrame, as_of: Column, loaded_by: str = "ledgerloom"
) -> DataFrame:
    """Ledger rows followed by the opening balance of every account."""
    return rows.unionByName(opening_rows(accounts, rows, as_of, loaded_by))


def expand_transfers(rows: DataFrame) -> DataFrame:
    """Add the incoming leg of every transfer that names both counter account and amount.

    Each row is read once: it is exploded into one or two legs, and the second leg swaps the
    own and counter columns.
    """
    has_mirror = (
        F.col("transfer_type").isNotNull()
        & F.col("transfer_account").isNotNull()
        & F.col("transfer_amount").isNotNull()
    )
    legs = F.when(has_mirror, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = rows.select("*", F.explode(legs).alias("_mirror"))
    mirrored = {name: F.col(other) for name, other in _SWAPPED.items()}
    mirrored["currency"] = F.coalesce("transfer_currency", "currency")
    mirrored["transfer_type"] = F.lit("transfer_in")
    return out.select(*(
        F.when(F.col("_mirror"), mirrored[name]).otherwise(F.col(name)).alias(name)
        if name in mirrored else F.col(name)
        for name in rows.columns
    ))


def enrich_accounts(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account flags by exact account name; NULL where the account is unknown."""
    flags = accounts.select(
        F.col("account_name").alias("account"),
        F.col("is_active").alias("is_active_account"),
        F.col("is_reserve").alias("is_reserve_account"),
        F.col("is_credit").alias("is_credit_account"),
    )
    return lookup_join(rows, flags, ["account"])

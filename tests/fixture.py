"""A small hand-checked ledger: five bookings, four accounts, six rates."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.schemas import DIM_ACCOUNTS, RAW_LEDGER_TEXT, TAG_DICTIONARY

SOURCE = ("app", "ledger", "raw_ledger")
LANDED_AT = datetime(2026, 8, 31)
RAW_SCHEMA = ("raw_id long, " + ", ".join(f"{c} string" for c in RAW_LEDGER_TEXT)
              + ", ingested_at timestamp, ingested_by string, source_file string, "
                "ingestion_id long")
RATE_SCHEMA = ("raw_id long, source string, source_rate_key string, rate_date string, "
               "base_currency string, base_amount string, quote_currency string, "
               "quote_amount string, ingested_at timestamp, ingested_by string")

BOOKINGS = [
    dict(source_number="1", transaction_date="2026-08-01 10:00:00", account="Wallet",
         amount="1000", currency="USD", parent_category="Income", category="Salary"),
    dict(source_number="2", transaction_date="2026-08-02 11:00:00", account=" Wallet ",
         amount="-100", currency="usd", parent_category="Expenses", category="Groceries",
         tags="regular"),
    dict(source_number="3", transaction_date="2026-08-03 12:00:00", account="Savings",
         amount="- 50,00", currency="USD", parent_category="Expenses", category="Repairs",
         tags="from reserve"),
    dict(source_number="4", transaction_date="2026-08-04 13:00:00", account="Card",
         amount="-300", currency="RUB", parent_category="Transfers", category="Transfer",
         transfer_account="Closed", transfer_amount="5", transfer_currency="USD"),
    dict(source_number="5", transaction_date="2026-08-05 14:00:00", account="Closed",
         amount="0", currency="USD", parent_category="Adjustments", category="Adjustment"),
]


def as_of():
    return F.lit("2026-08-31").cast("date")


def raw(spark, bookings=BOOKINGS, ingestion_id=1):
    rows = [
        (n, *(b.get(c) for c in RAW_LEDGER_TEXT), LANDED_AT, "loader", "a.csv", ingestion_id)
        for n, b in enumerate(bookings, 1)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def registry(spark, *entries):
    """Entries (id, status)."""
    return spark.createDataFrame(
        [(i, *SOURCE, status) for i, status in entries or [(1, "loaded")]],
        "ingestion_id long, source_system string, source_object string, raw_table string, "
        "status string",
    )


def raw_rates(spark, rows=None):
    rows = rows or [
        ("31.07.2026", "USD", "1", "90,5000"), ("01.08.2026", "USD", "1", "90,6000"),
        ("04.08.2026", "USD", "1", "91,1000"), ("31.08.2026", "USD", "1", "92,0000"),
        ("31.07.2026", "KGS", "10", "10,3500"), ("31.08.2026", "KGS", "10", "10,5000"),
    ]
    return spark.createDataFrame(
        [(n, "cbr", f"R{c}", d, c, nominal, "RUB", value, LANDED_AT, "loader")
         for n, (d, c, nominal, value) in enumerate(rows, 1)], RATE_SCHEMA)


def accounts(spark, rows=None):
    rows = rows or [
        (1, "Wallet", date(2012, 1, 2), Decimal(100), "USD", True, False, False),
        (2, "Savings", date(2013, 4, 2), Decimal(100), "USD", True, True, False),
        (3, "Closed", date(2015, 1, 2), Decimal(100), "USD", False, False, False),
        (4, "Card", date(2017, 7, 2), Decimal(100), "RUB", True, False, True),
    ]
    return spark.createDataFrame(rows, DIM_ACCOUNTS)


def tags(spark, *entries):
    return spark.createDataFrame(list(entries), TAG_DICTIONARY)

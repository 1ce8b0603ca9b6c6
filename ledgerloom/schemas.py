"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
QUOTE = T.DecimalType(18, 6)
RATE = T.DecimalType(24, 12)
CONVERTED = T.DecimalType(38, 6)
BALANCE = T.DecimalType(38, 2)

# --- Fixed values: they must equal what existing ledgers, exports and dashboards use. ---

# Export header -> raw column, in file order.
EXPORT_COLUMNS = {
    "Number": "source_number",
    "Date": "transaction_date",
    "Account": "account",
    "Amount": "amount",
    "Currency": "currency",
    "Parent Category": "parent_category",
    "Subcategory": "subcategory",
    "Category": "category",
    "Counterparty": "counterparty",
    "Transfer: Account": "transfer_account",
    "Transfer: Amount": "transfer_amount",
    "Transfer: Currency": "transfer_currency",
    "Tags": "tags",
    "Place": "place",
    "Note": "note",
}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RATE_DATE_FORMATS = {"cbr": "dd.MM.yyyy"}
REFERENCE_CURRENCIES = {"cbr": "RUB"}
PIVOT_CURRENCY = "RUB"
OPENING_NOTE = "Opening balance loaded from seed"
OPENING_SOURCE_FILE = "seed.dim_accounts"
HASH_SEPARATOR = "||"
TAG_SEPARATOR = ", "
ERROR_TEXT_LIMIT = 4000
FRESH_SECONDS = 259200
WARNING_SECONDS = 604800
FX_REFRESH_MINUTES = 360
FX_INITIAL_LOOKBACK_DAYS = 14
FX_RELOAD_LOOKBACK_DAYS = 7
LEDGER_TYPES = ["income", "expense", "other", "transfer_in", "transfer_out", "opening_balance"]
DISPLAY_TYPES = {
    "transfer_out": "Transfer out",
    "transfer_in": "Transfer in",
    "expense": "Expense",
    "income": "Income",
    "opening_balance": "Opening balance",
}
EXPENSE_TYPES = ["Recurring", "Reserve-funded", "Ad hoc"]
ACCOUNT_TYPES = ["Standard", "Reserve", "Credit"]
GRAINS = ["Day", "Week", "Month", "Quarter", "Year"]
FRESHNESS_STATUSES = ["fresh", "warning", "stale", "no_data"]
VOLUME_STATUSES = [
    "normal", "warning", "anomaly", "weak_baseline", "no_baseline", "invalid_baseline",
]

# --- Schemas ---

RAW_LEDGER_TEXT = list(EXPORT_COLUMNS.values())
RAW_RATE_TEXT = [
    "source", "source_rate_key", "rate_date", "base_currency", "base_amount",
    "quote_currency", "quote_amount",
]
RATE_KEY = ["source", "rate_date", "base_currency", "quote_currency"]
RATE_PAYLOAD = ["source_rate_key", "base_amount", "quote_amount"]

DIM_ACCOUNTS = T.StructType([
    T.StructField("account_id", T.IntegerType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("opening_date", T.DateType()),
    T.StructField("initial_amount", T.DecimalType(18, 3)),
    T.StructField("currency", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("is_reserve", T.BooleanType()),
    T.StructField("is_credit", T.BooleanType()),
])
TAG_DICTIONARY = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])
CATEGORY_MASK = T.StructType([
    T.StructField("real_parent_category", T.StringType()),
    T.StructField("real_category", T.StringType()),
    T.StructField("demo_parent_category", T.StringType()),
    T.StructField("demo_category", T.StringType()),
    T.StructField("amount_factor", QUOTE),
])
FILE_REGISTRY = T.StructType([
    T.StructField("ingestion_id", T.LongType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("source_object", T.StringType()),
    T.StructField("raw_table", T.StringType()),
    T.StructField("s3_bucket", T.StringType()),
    T.StructField("s3_key", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("file_checksum", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("discovered_at", T.TimestampType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
])
RATE_TABLE = T.StructType([
    T.StructField("raw_id", T.LongType()),
    *(T.StructField(name, T.StringType()) for name in RAW_RATE_TEXT),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("ingested_by", T.StringType()),
])
RATE_STATE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("currency_code", T.StringType()),
    T.StructField("last_checked_at", T.TimestampType()),
    T.StructField("last_requested_through", T.DateType()),
    T.StructField("last_rate_date", T.DateType()),
    T.StructField("last_rows_affected", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

"""Registered column functions (B1-B25), each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import derived, oracle
from ledgerloom.catalog.derived import Tables
from ledgerloom.catalog.marts import BASELINE, DEVIATION, RANKED, VOLUME
from ledgerloom.catalog.registry import query
from ledgerloom.functions import amounts, hashing, labels, text
from ledgerloom.operators.batches import filter_active
from ledgerloom.operators.loads import baseline_stats, latest_vs_baseline, load_rank
from ledgerloom.operators.masking import composite_key_left, redact_columns
from ledgerloom.schemas import MONEY, QUOTE

_AS_OF = f"TIMESTAMP '{derived.EVENTS_AS_OF}'"


def _as_of():
    return F.lit(derived.EVENTS_AS_OF).cast("timestamp")


_CLEANED = ["account", "counterparty", "subcategory", "transfer_amount", "tags", "note"]


@query("clean_text", "SELECT raw_id, "
       + ", ".join(f"nullif(trim({c}), '') AS {c}" for c in _CLEANED) + " FROM raw_transactions")
def clean_text(t: Tables):
    return t.raw_transactions.select("raw_id", *(text.clean_text(F.col(c)).alias(c) for c in _CLEANED))


@query("normalize_code", """
    SELECT raw_id, upper(nullif(trim(currency), '')) AS currency,
           upper(nullif(trim(transfer_currency), '')) AS transfer_currency FROM raw_transactions
""")
def normalize_code(t: Tables):
    return t.raw_transactions.select("raw_id", *(
        text.normalize_code(F.col(c)).alias(c) for c in ("currency", "transfer_currency")
    ))


@query("parse_timestamp", """
    SELECT raw_id, strptime(trim(transaction_date), '%Y-%m-%d %H:%M:%S') AS transaction_ts
    FROM raw_transactions
""")
def parse_timestamp(t: Tables):
    parsed = text.parse_timestamp(text.clean_text(F.col("transaction_date")))
    return t.raw_transactions.select("raw_id", parsed.alias("transaction_ts"))


@query("parse_date_by_source", """
    SELECT raw_id, CASE trim(source) WHEN 'cbr'
        THEN CAST(strptime(rate_date, '%d.%m.%Y') AS DATE) END AS rate_date FROM raw_rates
""")
def parse_date_by_source(t: Tables):
    parsed = text.parse_date_by_source(
        text.clean_text(F.col("rate_date")), text.clean_text(F.col("source"))
    )
    return t.raw_rates.select("raw_id", parsed.alias("rate_date"))


@query("parse_decimal", """
    SELECT raw_id, CAST(replace(replace(amount, ' ', ''), ',', '.') AS DECIMAL(18,2)) AS amount,
           CAST(nullif(replace(replace(transfer_amount, ' ', ''), ',', '.'), '')
                AS DECIMAL(18,2)) AS transfer_amount FROM raw_transactions
""")
def parse_decimal(t: Tables):
    return t.raw_transactions.select("raw_id", *(
        text.parse_decimal(text.clean_text(F.col(c)), MONEY).alias(c)
        for c in ("amount", "transfer_amount")
    ))


@query("flow_type", """
    SELECT raw_id, amount, CASE WHEN amount < 0 THEN 'expense' WHEN amount > 0 THEN 'income'
        ELSE 'zero' END AS flow_type FROM staged
""")
def flow_type(t: Tables):
    return t.staged().select("raw_id", "amount", amounts.flow_type(F.col("amount")).alias("flow_type"))


@query("is_transfer", """
    SELECT raw_id, NOT (transfer_account IS NULL AND transfer_amount IS NULL) AS is_transfer
    FROM staged
""")
def is_transfer(t: Tables):
    flag = amounts.is_transfer(F.col("transfer_account"), F.col("transfer_amount"))
    return t.staged().select("raw_id", flag.alias("is_transfer"))


@query("unit_rate", """
    SELECT raw_id, CASE WHEN base_amount <> 0 THEN
        CAST(CAST(quote_amount AS DOUBLE) / CAST(base_amount AS DOUBLE) AS DECIMAL(24,12))
        END AS rate FROM staged_rates
""")
def unit_rate(t: Tables):
    quote, base = (
        text.parse_decimal(text.clean_text(F.col(c)), QUOTE) for c in ("quote_amount", "base_amount")
    )
    return t.raw_rates.select("raw_id", amounts.unit_rate(quote, base).alias("rate"))


@query("amount_abs", """
    SELECT raw_id, CASE flow_type WHEN 'income' THEN amount ELSE abs(amount) END AS amount_abs
    FROM staged
""")
def amount_abs(t: Tables):
    value = amounts.amount_abs(F.col("amount"), F.col("flow_type"))
    return t.staged().select("raw_id", value.alias("amount_abs"))


@query("ledger_type", """
    SELECT raw_id, CASE WHEN is_transfer THEN 'transfer_out' WHEN flow_type = 'zero' THEN 'other'
        ELSE flow_type END AS transaction_type FROM staged
""")
def ledger_type(t: Tables):
    transfer = F.when(F.col("is_transfer"), "transfer_out")
    value = amounts.ledger_type(F.col("flow_type"), transfer)
    return t.staged().select("raw_id", value.alias("transaction_type"))


@query("content_hash", """
    SELECT raw_id, md5(concat_ws('||', """
       + ", ".join(f"coalesce({c}, '')" for c in (
           "source_number", "CAST(transaction_date AS VARCHAR)", "account", "CAST(amount AS VARCHAR)",
           "currency", "parent_category", "subcategory", "category", "counterparty",
           "transfer_account", "CAST(transfer_amount AS VARCHAR)", "transfer_currency", "tags",
           "place", "note", "CASE WHEN is_transfer THEN 'transfer_out' END", "source_file"))
       + ")) AS transaction_id FROM staged")
def content_hash(t: Tables):
    rows = t.staged().withColumnRenamed("transaction_date", "transaction_ts")
    rows = rows.withColumn("transfer_type", F.when(F.col("is_transfer"), "transfer_out"))
    return rows.select("raw_id", hashing.content_hash().alias("transaction_id"))


@query("display_type", f"""
    SELECT transaction_id, {oracle.SHOWN_TYPE} AS shown_type FROM ledger
""")
def display_type(t: Tables):
    shown = labels.display_type(F.col("transaction_type"))
    return t.ledger().select("transaction_id", shown.alias("shown_type"))


@query("expense_type", f"SELECT transaction_id, {oracle.EXPENSE_TYPE} AS expense_type FROM ledger")
def expense_type(t: Tables):
    words = F.split("tags", ", ")
    has = [F.array_contains(words, tag) for tag in ("recurring", "reserve")]
    return t.ledger().select("transaction_id", labels.expense_type(*has).alias("expense_type"))


@query("account_type", f"SELECT transaction_id, {oracle.ACCOUNT_TYPE} AS account_type FROM ledger")
def account_type(t: Tables):
    kind = labels.account_type(F.col("is_reserve_account"), F.col("is_credit_account"))
    return t.ledger().select("transaction_id", kind.alias("account_type"))


@query("period_labels", "SELECT o_orderkey, " + ", ".join(
    f"{oracle.period('o_orderdate', repr(g))} AS {g.lower()}_label" for g in labels.GRAINS
) + " FROM orders")
def period_labels(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.given("orders").select("o_orderkey", *(
        labels.period_label(day, g).alias(f"{g.lower()}_label") for g in labels.GRAINS
    ))


@query("filter_active", "SELECT transaction_id, account FROM ledger WHERE is_active_account")
def active_rows(t: Tables):
    return filter_active(t.ledger()).select("transaction_id", "account")



# Rates with all twelve digits, small and large ones, zero and missing ones.
_OWN_RATE = "CAST(o_orderkey * 7 + 1 AS DECIMAL(10,0)) * CAST(0.000001234567 AS DECIMAL(12,12))"
_TARGET_RATE = """CASE WHEN o_custkey % 5 = 4 THEN NULL
    ELSE CAST(o_custkey % 5 * o_custkey AS DECIMAL(10,0)) * CAST(0.000000021234 AS DECIMAL(12,12)) END"""


@query("convert_amount", f"""
    SELECT o_orderkey, target, {oracle.converted('price', 'own_rate', 'target_rate', 'own', 'target')} AS converted
    FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                 ['RUB', 'USD', 'KGS'][o_orderkey % 3 + 1] AS own,
                 ['RUB', 'USD', 'KGS'][o_custkey % 3 + 1] AS target,
                 {_OWN_RATE} AS own_rate, {_TARGET_RATE} AS target_rate
          FROM orders)
""")
def convert_amount(t: Tables):
    codes = F.array(F.lit("RUB"), F.lit("USD"), F.lit("KGS"))
    own, target = (codes[(F.col(key) % 3).cast("int")] for key in ("o_orderkey", "o_custkey"))
    value = amounts.convert_amount(
        F.col("o_totalprice").cast("decimal(18,2)"), own, target, F.expr(_OWN_RATE), F.expr(_TARGET_RATE))
    return t.given("orders").select("o_orderkey", target.alias("target"), value.alias("converted"))


@query("mask_amount", """
    SELECT transaction_id, CAST(round(CAST(amount AS DECIMAL(28,2)) * coalesce(amount_factor, 1), 2)
               AS DECIMAL(18,2)) AS masked,
           CAST(abs(round(CAST(amount AS DECIMAL(28,2)) * coalesce(amount_factor, 1), 2))
                AS DECIMAL(18,2)) AS masked_abs
    FROM ledger LEFT JOIN category_mask
        ON real_parent_category = parent_category AND real_category = category
""")
def mask_amount(t: Tables):
    rows = composite_key_left(t.ledger(), t.category_mask)
    amount, factor = F.col("amount"), F.col("amount_factor")
    return rows.select(
        "transaction_id", amounts.mask_amount(amount, factor).alias("masked"),
        amounts.mask_amount(amount, factor, absolute=True).alias("masked_abs"),
    )


@query("redact_columns", """
    SELECT transaction_id, CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS VARCHAR) AS note FROM ledger
""")
def redacted(t: Tables):
    return redact_columns(t.ledger(), ["tags", "note"]).select("transaction_id", "tags", "note")


_SECONDS = f"CAST(round((epoch_us({_AS_OF}) - epoch_us(ts)) / 1000000) AS BIGINT)"


@query("age_seconds", f"SELECT event_id, {_SECONDS} AS seconds FROM events")
def age_seconds(t: Tables):
    return t.given("events").select(
        "event_id", labels.age_seconds(_as_of(), F.col("ts")).alias("seconds")
    )


@query("duration_text", f"""
    SELECT event_id, {_SECONDS} // 86400 || ' d ' || {_SECONDS} % 86400 // 3600 || ' h '
        || {_SECONDS} % 3600 // 60 || ' min' AS duration FROM events
""")
def duration_text(t: Tables):
    seconds = labels.age_seconds(_as_of(), F.col("ts"))
    return t.given("events").select("event_id", labels.duration_text(seconds).alias("duration"))


@query("threshold_class", f"""
    SELECT ingestion_id, CASE WHEN finished_at IS NULL THEN 'no_data'
        WHEN epoch_us({_AS_OF}) - epoch_us(finished_at) < 259200500000 THEN 'fresh'
        WHEN epoch_us({_AS_OF}) - epoch_us(finished_at) < 604800500000 THEN 'warning'
        ELSE 'stale' END AS freshness_status FROM load_registry
""")
def threshold_class(t: Tables):
    seconds = labels.age_seconds(_as_of(), F.col("finished_at"))
    status = labels.freshness_class(F.col("finished_at"), seconds)
    return t.load_registry.select("ingestion_id", status.alias("freshness_status"))


_LATEST = f"""FROM (SELECT * FROM ({RANKED}) WHERE load_rank = 1)
    LEFT JOIN ({BASELINE}) USING (source_system, source_object, raw_table)"""


def _latest(t: Tables):
    ranked = load_rank(t.load_registry.filter("status = 'loaded'"), upto=8)
    return latest_vs_baseline(ranked, baseline_stats(ranked))


@query("deviation_pct", f"""
    SELECT source_object, CAST({DEVIATION} AS DECIMAL(18,2)) AS deviation_pct {_LATEST}
""")
def deviation_pct(t: Tables):
    value = labels.deviation_pct(F.col("rows_loaded"), F.col("avg_rows_loaded"))
    return _latest(t).select("source_object", value.alias("deviation_pct"))


@query("volume_class", f"SELECT source_object, {VOLUME} AS volume_status {_LATEST}")
def volume_class(t: Tables):
    status = labels.volume_class(
        F.col("rows_loaded"), F.col("baseline_load_count"), F.col("avg_rows_loaded")
    )
    return _latest(t).select("source_object", status.alias("volume_status"))


@query("truncate_text", "SELECT doc_id, left(text, 4000) AS text FROM documents")
def truncate_text(t: Tables):
    return t.given("documents").select("doc_id", text.truncate_text(F.col("text")).alias("text"))


@query("blank_or_null", """
    SELECT raw_id, coalesce(trim(counterparty), '') = '' OR coalesce(trim(subcategory), '') = ''
        OR note IS NULL AS is_missing FROM raw_transactions
""")
def blank_or_null(t: Tables):
    missing = text.any_missing([F.col("counterparty"), F.col("subcategory")], [F.col("note")])
    return t.raw_transactions.select("raw_id", missing.alias("is_missing"))

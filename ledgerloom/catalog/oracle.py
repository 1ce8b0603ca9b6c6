"""The same tables restated in DuckDB SQL, to compare results with."""

from __future__ import annotations

import re

from ledgerloom.catalog import derived

_RAW_TEXT = [
    "source_number", "account", "parent_category", "subcategory", "category", "counterparty",
    "transfer_account", "tags", "place", "note", "ingested_by", "source_file",
]


def _trimmed(name: str) -> str:
    return f"nullif(trim({name}), '')"


def _number(name: str, kind: str) -> str:
    return f"CAST(replace(replace({_trimmed(name)}, ' ', ''), ',', '.') AS {kind})"


STAGED = f"""
SELECT *, CASE sign(coalesce(amount, 0)) WHEN -1 THEN 'expense' WHEN 1 THEN 'income'
          ELSE 'zero' END AS flow_type,
       transfer_account IS NOT NULL OR transfer_amount IS NOT NULL AS is_transfer
FROM (SELECT raw_id, {', '.join(f'{_trimmed(c)} AS {c}' for c in _RAW_TEXT)},
             strptime({_trimmed('transaction_date')}, '%Y-%m-%d %H:%M:%S') AS transaction_date,
             {_number('amount', 'DECIMAL(18,2)')} AS amount,
             {_number('transfer_amount', 'DECIMAL(18,2)')} AS transfer_amount,
             upper({_trimmed('currency')}) AS currency,
             upper({_trimmed('transfer_currency')}) AS transfer_currency,
             ingested_at, ingestion_id
      FROM raw_transactions
      WHERE ingestion_id = (SELECT max(ingestion_id) FROM ledger_registry
                            WHERE status = 'loaded'))
"""

STAGED_RATES = f"""
SELECT raw_id, source, source_rate_key,
       CASE source WHEN 'cbr' THEN CAST(strptime(day_text, '%d.%m.%Y') AS DATE) END AS rate_date,
       base_currency, base_amount, quote_currency, quote_amount,
       CAST(CAST(quote_amount AS DOUBLE) / nullif(CAST(base_amount AS DOUBLE), 0)
            AS DECIMAL(24,12)) AS rate,
       ingested_at, ingested_by
FROM (SELECT raw_id, {_trimmed('source')} AS source,
             {_trimmed('source_rate_key')} AS source_rate_key,
             {_trimmed('rate_date')} AS day_text,
             upper({_trimmed('base_currency')}) AS base_currency,
             {_number('base_amount', 'DECIMAL(18,6)')} AS base_amount,
             upper({_trimmed('quote_currency')}) AS quote_currency,
             {_number('quote_amount', 'DECIMAL(18,6)')} AS quote_amount,
             ingested_at, {_trimmed('ingested_by')} AS ingested_by
      FROM raw_rates)
"""

_LEG_TAIL = ("parent_category, subcategory, category, counterparty, tags, place, note, flow_type, "
             "ingested_at, ingested_by, source_file, ingestion_id")

OPENINGS = f"""
SELECT NULL AS source_number, CAST(opening_date AS TIMESTAMP) AS transaction_ts,
       account_name AS account, initial_amount AS amount, currency,
       CAST(NULL AS VARCHAR) AS transfer_account, CAST(NULL AS DECIMAL(18,2)) AS transfer_amount,
       CAST(NULL AS VARCHAR) AS transfer_currency, CAST(NULL AS VARCHAR) AS transfer_type,
       NULL AS parent_category, NULL AS subcategory, NULL AS category, NULL AS counterparty,
       NULL AS tags, NULL AS place, 'Opening balance loaded from seed' AS note,
       'opening_balance' AS flow_type, TIMESTAMP '{derived.AS_OF} 00:00:00' AS ingested_at,
       'ledgerloom' AS ingested_by, 'seed.dim_accounts' AS source_file, NULL AS ingestion_id
FROM dim_accounts
"""

LEGS = f"""
SELECT source_number, transaction_date AS transaction_ts, account, amount, currency,
       transfer_account, transfer_amount, transfer_currency,
       CASE WHEN is_transfer THEN 'transfer_out' END AS transfer_type, {_LEG_TAIL}
FROM staged
UNION ALL
SELECT source_number, transaction_date, transfer_account, transfer_amount,
       coalesce(transfer_currency, currency), account, amount, currency, 'transfer_in', {_LEG_TAIL}
FROM staged WHERE transfer_account IS NOT NULL AND transfer_amount IS NOT NULL
UNION ALL BY NAME
SELECT * FROM openings
"""

_HASHED = [
    "source_number", "CAST(transaction_ts AS VARCHAR)", "account", "CAST(amount AS VARCHAR)",
    "currency", "parent_category", "subcategory", "category", "counterparty",
    "transfer_account", "CAST(transfer_amount AS VARCHAR)", "transfer_currency", "tags", "place",
    "note", "transfer_type", "source_file",
]

LEDGER = f"""
SELECT md5({" || '||' || ".join(f"coalesce({part}, '')" for part in _HASHED)}) AS transaction_id,
       l.* EXCLUDE (flow_type, transfer_type),
       CASE WHEN flow_type IN ('income', 'opening_balance') THEN amount
            ELSE abs(amount) END AS amount_abs,
       coalesce(transfer_type, CASE WHEN flow_type = 'zero' THEN 'other' ELSE flow_type END)
           AS transaction_type,
       d.is_active AS is_active_account, d.is_reserve AS is_reserve_account,
       d.is_credit AS is_credit_account
FROM legs AS l
LEFT JOIN (SELECT account_name, is_active, is_reserve, is_credit FROM dim_accounts) AS d
    ON d.account_name = l.account
"""

TARGETS = """
SELECT base_currency AS target_currency FROM staged_rates
UNION SELECT currency FROM ledger UNION SELECT 'RUB'
"""

RATE_POINTS = """
SELECT base_currency, rate_date, CAST(rate AS DOUBLE) AS rate, rate AS exact_rate
FROM staged_rates WHERE rate_date IS NOT NULL
"""

SHOWN_TYPE = """CASE transaction_type WHEN 'transfer_out' THEN 'Transfer out'
    WHEN 'transfer_in' THEN 'Transfer in' WHEN 'expense' THEN 'Expense'
    WHEN 'income' THEN 'Income' WHEN 'opening_balance' THEN 'Opening balance' END"""
ACCOUNT_TYPE = """CASE WHEN is_reserve_account THEN 'Reserve' WHEN is_credit_account THEN 'Credit'
    ELSE 'Standard' END"""
EXPENSE_TYPE = """CASE WHEN list_contains(str_split(tags, ', '), 'recurring') THEN 'Recurring'
    WHEN list_contains(str_split(tags, ', '), 'reserve') THEN 'Reserve-funded'
    ELSE 'Ad hoc' END"""
GRAINS = "['Day', 'Week', 'Month', 'Quarter', 'Year']"


def period(day: str, grain: str = "period_grain") -> str:
    """Label of a day's period."""
    return f"""CASE {grain} WHEN 'Day' THEN strftime({day}, '%Y-%m-%d')
        WHEN 'Week' THEN strftime(date_trunc('week', {day}), '%Y-%m-%d')
        WHEN 'Month' THEN strftime({day}, '%Y-%m')
        WHEN 'Quarter' THEN year({day}) || '-Q' || quarter({day})
        WHEN 'Year' THEN CAST(year({day}) AS VARCHAR) END"""


def _whole(number: str, digits: int) -> str:
    """A decimal with so many digits after the point as a whole number of its last place."""
    return f"CAST(replace(CAST(CAST({number} AS DECIMAL(38,{digits})) AS VARCHAR), '.', '') AS HUGEINT)"


def converted(amount: str, own: str = "o.exact_rate", target: str = "t.exact_rate",
              currency: str = "f.currency", target_currency: str = "f.target_currency") -> str:
    """Amount in the target currency, in whole numbers: millionths are
    cents * own / target * 10^4, rounded half away from zero."""
    one = f"CAST({10 ** 12} AS HUGEINT)"
    own12 = f"CASE WHEN {currency} = 'RUB' THEN {one} ELSE {_whole(own, 12)} END"
    target12 = f"CASE WHEN {target_currency} = 'RUB' THEN {one} ELSE nullif({_whole(target, 12)}, 0) END"
    cents = _whole(amount, 2)
    return f"""CASE WHEN {currency} = {target_currency} THEN CAST({amount} AS DECIMAL(38,6))
        ELSE CAST(sign({cents}) * ((2 * abs({cents}) * ({own12}) * 10000 + ({target12})) // (2 * ({target12})))
            AS DECIMAL(32,0)) * CAST(0.000001 AS DECIMAL(6,6)) END"""


def asof(day: str) -> str:
    """Own and target rate as of a day, for rows f."""
    return f"""ASOF LEFT JOIN rate_points AS o
        ON o.base_currency = f.currency AND o.rate_date <= {day}
    ASOF LEFT JOIN rate_points AS t
        ON t.base_currency = f.target_currency AND t.rate_date <= {day}"""


def _facts(rows: str) -> str:
    return f"""
    SELECT f.transaction_date, f.account, f.currency, f.parent_category, f.category, f.tags,
           f.note, f.transaction_type, f.expense_type, f.account_type, g.period_grain,
           {period('f.transaction_date', 'g.period_grain')} AS period, f.target_currency,
           {converted('f.amount_abs')} AS amount_abs_converted
    FROM (SELECT r.*, c.target_currency FROM {rows} AS r CROSS JOIN targets AS c) AS f
    {asof('CAST(f.transaction_date AS DATE)')}
    CROSS JOIN (SELECT unnest({GRAINS}) AS period_grain) AS g
    """


CLASSIFIED = f"""
SELECT transaction_ts AS transaction_date, account, currency, parent_category, category, tags,
       note, {SHOWN_TYPE} AS transaction_type, {EXPENSE_TYPE} AS expense_type,
       {ACCOUNT_TYPE} AS account_type, amount_abs, amount
FROM ledger WHERE is_active_account
"""

MASKED_ROWS = """
SELECT c.transaction_date, e.account_name AS account, c.currency,
       m.demo_parent_category AS parent_category, m.demo_category AS category,
       CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS VARCHAR) AS note, c.transaction_type,
       c.expense_type, c.account_type,
       abs(round(CAST(c.amount AS DECIMAL(28,2)) * coalesce(m.amount_factor, 1), 2)) AS amount_abs
FROM classified AS c
LEFT JOIN dim_accounts AS d ON d.account_name = c.account
LEFT JOIN dim_accounts_demo AS e ON e.account_id = d.account_id
LEFT JOIN category_mask AS m
    ON m.real_parent_category = c.parent_category AND m.real_category = c.category
"""

MASKED_LEDGER = """
SELECT l.transaction_ts, e.account_name AS account,
       CAST(round(CAST(l.amount AS DECIMAL(28,2)) * coalesce(m.amount_factor, 1), 2)
            AS DECIMAL(18,2)) AS amount,
       l.currency, l.transaction_type, l.is_reserve_account, l.is_credit_account
FROM ledger AS l
LEFT JOIN dim_accounts AS d ON d.account_name = l.account
LEFT JOIN dim_accounts_demo AS e ON e.account_id = d.account_id
LEFT JOIN category_mask AS m
    ON m.real_parent_category = l.parent_category AND m.real_category = l.category
WHERE l.is_active_account
"""


def _bounds(rows: str) -> str:
    return f"""
    SELECT account, CAST(min(transaction_ts) AS DATE) AS balance_start_date,
           max(currency) FILTER (transaction_type = 'opening_balance') AS currency,
           bool_or(is_reserve_account) AS is_reserve_account,
           bool_or(is_credit_account) AS is_credit_account
    FROM {rows} GROUP BY account
    """


def _spine(bounds: str) -> str:
    return f"""
    SELECT b.*, CAST(unnest(generate_series(balance_start_date, DATE '{derived.AS_OF}',
                                            INTERVAL 1 DAY)) AS DATE) AS snapshot_date
    FROM {bounds} AS b WHERE balance_start_date <= DATE '{derived.AS_OF}'
    """


def _daily(spine: str, rows: str) -> str:
    return f"""
    SELECT s.account, s.currency, {ACCOUNT_TYPE} AS account_type, s.snapshot_date,
           sum(coalesce(d.day_amount, 0)) OVER
               (PARTITION BY s.account ORDER BY s.snapshot_date) AS balance
    FROM {spine} AS s
    LEFT JOIN (SELECT account, CAST(transaction_ts AS DATE) AS snapshot_date,
                      sum(amount) AS day_amount FROM {rows} GROUP BY ALL) AS d
        ON d.account = s.account AND d.snapshot_date = s.snapshot_date
    """


def _snapshots(daily: str) -> str:
    return f"""
    SELECT account, account_type, currency, period_grain, period,
           max(snapshot_date) AS period_end, arg_max(balance, snapshot_date) AS balance
    FROM (SELECT d.*, g.period_grain, {period('d.snapshot_date', 'g.period_grain')} AS period
          FROM {daily} AS d CROSS JOIN (SELECT unnest({GRAINS}) AS period_grain) AS g)
    GROUP BY account, account_type, currency, period_grain, period
    """


def _balances(snapshots: str) -> str:
    return f"""
    SELECT f.account, f.account_type, f.period_grain, f.period, f.period_end, f.currency,
           f.balance, f.target_currency, {converted('f.balance')} AS balance_converted
    FROM (SELECT s.*, c.target_currency FROM {snapshots} AS s CROSS JOIN targets AS c) AS f
    {asof('f.period_end')}
    """


CTES: dict[str, str] = {
    **{name: derived.duckdb_sql(name) for name in derived._TEXTS},
    "staged": STAGED,
    "staged_rates": STAGED_RATES,
    "openings": OPENINGS,
    "legs": LEGS,
    "ledger": LEDGER,
    "active": "SELECT * FROM ledger WHERE is_active_account",
    "targets": TARGETS,
    "rate_points": RATE_POINTS,
    "classified": CLASSIFIED,
    "facts": _facts("classified"),
    "masked_rows": MASKED_ROWS,
    "masked_facts": _facts("masked_rows"),
    "bounds": _bounds("active"),
    "spine": _spine("bounds"),
    "daily": _daily("spine", "active"),
    "snapshots": _snapshots("daily"),
    "balances": _balances("snapshots"),
    "masked_ledger": MASKED_LEDGER,
    "masked_bounds": _bounds("masked_ledger"),
    "masked_spine": _spine("masked_bounds"),
    "masked_daily": _daily("masked_spine", "masked_ledger"),
    "masked_snapshots": _snapshots("masked_daily"),
    "masked_balances": _balances("masked_snapshots"),
}


def with_tables(body: str) -> str:
    """Put the definitions of all tables a statement names in front of it."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    tables = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    body = body.strip()
    return f"WITH {tables}\n{body}" if tables else body

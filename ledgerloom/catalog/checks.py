"""Registered data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog.derived import SOURCE, Tables
from ledgerloom.catalog.registry import query
from ledgerloom.plans.core import core_rates, core_transactions
from ledgerloom.plans.pipeline import log_checks
from ledgerloom.plans.staging import stg_transactions
from ledgerloom.quality import checks, suite
from ledgerloom.session import shared_dir


@query("chk_not_null", "SELECT raw_id, rate_date FROM staged_rates WHERE rate_date IS NULL")
def chk_not_null(t: Tables):
    return checks.not_null(t.staged_rates(), "rate_date").select("raw_id", "rate_date")


@query("chk_unique", """
    SELECT transfer_account, count(*) AS n_records FROM staged WHERE transfer_account IS NOT NULL
    GROUP BY ALL HAVING n_records > 1
""")
def chk_unique(t: Tables):
    return checks.unique(t.staged(), "transfer_account")


@query("chk_accepted_values", """
    SELECT transaction_id, transaction_type FROM ledger
    WHERE transaction_type NOT IN ('income', 'expense', 'transfer_in', 'transfer_out')
""")
def chk_accepted_values(t: Tables):
    kinds = ["income", "expense", "transfer_in", "transfer_out"]
    return checks.accepted_values(t.ledger(), "transaction_type", kinds).select(
        "transaction_id", "transaction_type"
    )


@query("chk_relationships", """
    SELECT transaction_id, currency FROM ledger WHERE currency <> 'RUB'
        AND currency NOT IN (SELECT base_currency FROM staged_rates)
""")
def chk_relationships(t: Tables):
    return checks.relationships(
        t.ledger().select("transaction_id", "currency"), "currency", t.staged_rates(),
        "base_currency", "currency != 'RUB'",
    ).select("transaction_id", "currency")


@query("chk_unique_combination", """
    SELECT base_currency, rate_date, count(*) AS n_records FROM staged_rates
    GROUP BY ALL HAVING n_records > 1
""")
def chk_unique_combination(t: Tables):
    return checks.unique_combination(t.staged_rates(), ["base_currency", "rate_date"])


@query("chk_positive", "SELECT raw_id, base_amount FROM staged_rates WHERE base_amount <= 0")
def chk_positive(t: Tables):
    return checks.positive(t.staged_rates(), "base_amount").select("raw_id", "base_amount")


@query("chk_active_tags_exist", """
    SELECT tag FROM many_tags WHERE is_active AND tag NOT IN
        (SELECT trim(unnest(str_split(tags, ','))) FROM raw_transactions WHERE trim(tags) <> '')
""")
def chk_active_tags_exist(t: Tables):
    return checks.active_tags_exist(t.many_tags, t.raw_transactions)


@query("chk_accounts_in_dim", """
    SELECT DISTINCT account AS account_name FROM ledger WHERE is_active_account IS NULL
""")
def chk_accounts_in_dim(t: Tables):
    return checks.accounts_in_dim(t.ledger(), t.dim_accounts)


@query("chk_single_currency", """
    SELECT account, count(DISTINCT currency) AS currency_count FROM active
    GROUP BY account HAVING currency_count > 1
""")
def chk_single_currency(t: Tables):
    return checks.single_currency(t.ledger())


@query("chk_max_one_active", """
    SELECT count(*) AS active_row_count
    FROM (SELECT DISTINCT transfer_currency AS tag, transfer_currency IS NOT NULL AS is_active
          FROM staged) WHERE is_active HAVING active_row_count > 1
""")
def chk_max_one_active(t: Tables):
    codes = t.staged().select(F.col("transfer_currency").alias("tag")).distinct()
    return checks.max_one_active(codes.withColumn("is_active", F.col("tag").isNotNull()))


@query("chk_mapping_coverage", """
    SELECT DISTINCT parent_category, category FROM ledger AS l
    WHERE category IS NOT NULL AND NOT EXISTS (SELECT 1 FROM category_mask AS m
        WHERE m.real_parent_category = l.parent_category AND m.real_category = l.category)
""")
def chk_mapping_coverage(t: Tables):
    return checks.mapping_coverage(t.ledger(), t.category_mask)


@query("chk_mapping_unique", """
    SELECT real_parent_category, real_category, count(*) AS mapping_count FROM dirty_mask
    GROUP BY ALL HAVING mapping_count > 1
""")
def chk_mapping_unique(t: Tables):
    return checks.mapping_unique(t.dirty_mask)


@query("chk_mapping_required", """
    SELECT * FROM dirty_mask WHERE trim(demo_category) = '' OR amount_factor IS NULL
""")
def chk_mapping_required(t: Tables):
    return checks.mapping_required(t.dirty_mask)


def build_suite(t: Tables) -> suite.Suite:
    """Staging, core, reference data and mask checks over the derived ledger."""
    raw, masks = t.stored(t.raw_transactions, "raw"), t.stored(t.dirty_mask, "masks")
    staged = t.stored(stg_transactions(raw, t.ledger_registry, *SOURCE), "staged")
    staged_rates = t.stored(t.staged_rates(), "staged_rates")
    ledger = t.stored(core_transactions(staged, t.dim_accounts, t.as_of), "ledger")
    run = suite.Suite()
    suite.staging_checks(run, staged, staged_rates)
    suite.core_checks(run, ledger, core_rates(staged_rates), t.dim_accounts)
    suite.seed_checks(run, t.dim_accounts, {"recurring_tag": t.recurring_tag,
                                            "reserve_tag": t.reserve_tag}, raw)
    return suite.mask_checks(run, ledger, masks)


def _suite_sql() -> str:
    """The suite restated check by check."""
    def nulls(table, *columns):
        return {f"not_null_{c}": f"SELECT 1 FROM {table} WHERE {c} IS NULL" for c in columns}

    def twice(table, *columns, nulls_too=True):
        keep = "" if nulls_too else f"WHERE {columns[0]} IS NOT NULL"
        names = ", ".join(columns)
        return f"SELECT 1 FROM {table} {keep} GROUP BY {names} HAVING count(*) > 1"

    def unique(table, *columns):
        return {f"unique_{c}": twice(table, c, nulls_too=False) for c in columns}

    def positive(*columns):
        return {f"positive_{c}": f"SELECT 1 FROM staged_rates WHERE {c} <= 0" for c in columns}

    def rates(*extra):
        return {
            "unique_combination": twice("staged_rates", "base_currency", "rate_date"),
            **unique("staged_rates", "raw_id"),
            **nulls("staged_rates", "raw_id", "source", "rate_date", "base_currency",
                    "quote_currency", "rate", *extra),
            **positive("rate"),
            "accepted_values_source": "SELECT 1 FROM staged_rates WHERE source <> 'cbr'",
        }

    def tags(table):
        return {
            **unique(table, "tag"), **nulls(table, "tag", "is_active"),
            "active_tags_exist_in_raw": f"""SELECT 1 FROM {table} WHERE is_active AND tag NOT IN
                (SELECT trim(unnest(str_split(tags, ','))) FROM raw_transactions
                 WHERE trim(tags) <> '')""",
            "at_most_one_active_row": f"""SELECT 1 FROM {table} WHERE is_active
                HAVING count(*) > 1""",
        }

    stg, core = "stg_fact_transaction", "core_fact_transaction"
    models = {
        (stg, "warn"): {
            "unique_combination": twice(
                "staged", "source_number", "transaction_date", "account", "amount", "currency",
                "transfer_account", "transfer_amount", "transfer_currency"),
            **unique("staged", "raw_id"),
            **nulls("staged", "raw_id", "transaction_date", "account", "amount", "currency",
                    "ingested_at", "ingested_by", "source_file", "ingestion_id", "flow_type",
                    "is_transfer"),
            "accepted_values_flow_type":
                "SELECT 1 FROM staged WHERE flow_type NOT IN ('income', 'expense', 'zero')",
        },
        ("stg_exchange_rate", "warn"): {
            **rates("source_rate_key", "base_amount", "quote_amount", "ingested_at", "ingested_by"),
            **positive("base_amount", "quote_amount"),
        },
        ("core_exchange_rate", "error"): rates(),
        (core, "error"): {
            **unique("ledger", "transaction_id"),
            **nulls("ledger", "transaction_id", "transaction_ts", "account", "currency",
                    "amount_abs", "transaction_type", "ingested_at", "source_file"),
            "accepted_values_transaction_type": """SELECT 1 FROM ledger WHERE transaction_type
                NOT IN ('income', 'expense', 'other', 'transfer_in', 'transfer_out',
                        'opening_balance')""",
            "accounts_exist_in_dim_accounts":
                "SELECT DISTINCT account FROM ledger WHERE is_active_account IS NULL",
            "accounts_have_single_currency": """SELECT 1 FROM active GROUP BY account
                HAVING count(DISTINCT currency) > 1""",
        },
        ("seed_dim_accounts", "error"): {
            **unique("dim_accounts", "account_id", "account_name"),
            **nulls("dim_accounts", "account_id", "account_name", "opening_date",
                    "initial_amount", "currency", "is_active", "is_reserve", "is_credit"),
        },
        ("seed_recurring_tag", "error"): tags("recurring_tag"),
        ("seed_reserve_tag", "error"): tags("reserve_tag"),
        ("demo_category_mapping", "error"): {
            "categories_are_mapped": """SELECT DISTINCT parent_category, category FROM ledger
                WHERE category IS NOT NULL AND (parent_category, category) NOT IN
                    (SELECT (real_parent_category, real_category) FROM dirty_mask)""",
            "unique_real_categories": twice("dirty_mask", "real_parent_category", "real_category"),
            "required_values":
                "SELECT 1 FROM dirty_mask WHERE trim(demo_category) = '' OR amount_factor IS NULL",
        },
    }
    parts = []
    for (model, severity), tests in models.items():
        for name, sql in tests.items():
            level = "warn" if name == "active_tags_exist_in_raw" else severity
            parts.append(f"SELECT '{model}' AS model_name, '{name}' AS test_name, "
                         f"'{level}' AS severity, count(*) AS failures FROM ({sql})")
    return ("SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' "
            f"ELSE 'warn' END AS status FROM ({' UNION ALL '.join(parts)})")


@query("check_suite", _suite_sql())
def check_suite(t: Tables):
    return build_suite(t).run()


_LOGGED = "model_name || '.' || test_name AS unique_id, test_name, severity, status, failures"
_RUNS = [("dev", "first"), ("prod", "first"), ("dev", "second")]


def _log(t: Tables, kind: str) -> DataFrame:
    path = shared_dir(t.spark, "checks")
    results = t.stored(build_suite(t).run(), "results")
    # The first run is logged twice, as after a failure between two writes.
    for target, invocation in [_RUNS[0], *_RUNS]:
        log_checks(results, path, target, invocation, t.as_of)
    return t.spark.read.parquet(f"{path}/{kind}").select(
        "target_name", "invocation_id", "unique_id", "test_name", "severity", "status", "failures", "message")


def _runs_sql(runs: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"('{target}', '{run}')" for target, run in runs)
    return f"""SELECT target_name, invocation_id, {_LOGGED},
        CASE WHEN failures > 0 THEN failures || ' failing rows' END AS message
        FROM ({_suite_sql()}) CROSS JOIN (VALUES {rows}) AS r(target_name, invocation_id)"""


@query("check_history", _runs_sql(_RUNS))
def check_history(t: Tables):
    return _log(t, "history")


@query("check_current", _runs_sql(_RUNS[1:]))
def check_current(t: Tables):
    return _log(t, "current")

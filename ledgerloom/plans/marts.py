"""Fact and balance marts and their masked twins (M5-M8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import mask_amount
from ledgerloom.functions.labels import account_type, display_type, expense_type
from ledgerloom.operators.balances import balance_intervals
from ledgerloom.operators.batches import filter_active
from ledgerloom.operators.conversion import convert_to_targets
from ledgerloom.operators.masking import composite_key_left, redact_columns, two_hop_dim
from ledgerloom.operators.periods import (
    calendar_spine, in_own_stage, unpack_periods, with_closing_periods, with_periods,
)
from ledgerloom.operators.tags import tag_flags, tag_membership_join
from ledgerloom.operators.targets import target_currency_set
from ledgerloom.schemas import GRAINS, PIVOT_CURRENCY

_FACT_COLUMNS = [
    "transaction_date", "account", "currency", "parent_category", "category", "tags", "note",
    "transaction_type", "expense_type", "account_type", "period_grain", "period",
    "target_currency", "amount_abs_converted",
]
_BALANCE_COLUMNS = [
    "account", "account_type", "period_grain", "period", "period_end", "currency", "balance",
    "target_currency", "balance_converted",
]


def classified(
    ledger: DataFrame, recurring: DataFrame, reserve_funded: DataFrame, one_row_each: bool = False
) -> DataFrame:
    """Active ledger rows with their labels.

    By default a row that matches several active tags of one dictionary appears once per
    match; ``one_row_each`` keeps every row single.
    """
    flag = tag_flags if one_row_each else tag_membership_join
    rows = flag(filter_active(ledger), recurring, "_recurring")
    rows = flag(rows, reserve_funded, "_reserve_funded")
    return rows.withColumns({
        "transaction_date": F.col("transaction_ts"),
        "transaction_type": display_type(F.col("transaction_type")),
        "expense_type": expense_type(F.col("_recurring"), F.col("_reserve_funded")),
        "account_type": account_type(F.col("is_reserve_account"), F.col("is_credit_account")),
    })


def _targets(named, rates, ledger, pivot):
    if named is None:
        return target_currency_set(rates, ledger, pivot)
    return rates.sparkSession.createDataFrame([(t,) for t in named], "target_currency string")


def _fact_rows(rows, ledger, rates, pivot, numeric, grains, targets, unpack=True):
    # A rate depends on the date, not on the grain, so the grains come last; their labels depend on
    # the date too and not on the target.
    day = F.col("transaction_date").cast("date")
    rows = with_periods(rows.select(*_FACT_COLUMNS[:10], "amount_abs"), day, grains)
    converted = convert_to_targets(
        rows, rates, _targets(targets, rates, ledger, pivot), "amount_abs",
        day, "amount_abs_converted", pivot=pivot, numeric=numeric,
    )
    return unpacked_facts(converted) if unpack else converted.drop("amount_abs")


def unpacked_facts(facts: DataFrame) -> DataFrame:
    """Rows of the fact mart from facts that hold a list of their periods."""
    return unpack_periods(facts).select(*_FACT_COLUMNS)


def fact_mart(
    ledger: DataFrame,
    rates: DataFrame,
    recurring: DataFrame,
    reserve_funded: DataFrame,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
    grains: list[str] = GRAINS,
    one_row_each: bool = False,
    targets: list[str] | None = None,
    unpack: bool = True,
) -> DataFrame:
    """Transactions of active accounts per period grain and reporting currency.

    A read that needs few grains or currencies names them, so that no others are computed. Without
    ``unpack`` a transaction appears once per currency and holds the list of its periods.
    """
    rows = classified(ledger, recurring, reserve_funded, one_row_each)
    return _fact_rows(rows, ledger, rates, pivot, numeric, grains, targets, unpack)


def fact_mart_masked(
    ledger: DataFrame,
    rates: DataFrame,
    recurring: DataFrame,
    reserve_funded: DataFrame,
    accounts: DataFrame,
    accounts_demo: DataFrame,
    masks: DataFrame,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
    grains: list[str] = GRAINS,
    one_row_each: bool = False,
    targets: list[str] | None = None,
) -> DataFrame:
    """As ``fact_mart`` with demo accounts and categories and scaled amounts."""
    rows = classified(ledger, recurring, reserve_funded, one_row_each)
    rows = composite_key_left(two_hop_dim(rows, accounts, accounts_demo), masks)
    rows = redact_columns(rows, ["tags", "note"]).withColumns({
        "account": F.col("demo_account"),
        "amount_abs": mask_amount(F.col("amount"), F.col("amount_factor"), absolute=True),
        "parent_category": F.col("demo_parent_category"),
        "category": F.col("demo_category"),
    })
    return _fact_rows(rows, ledger, rates, pivot, numeric, grains, targets)


def _balance_rows(active, ledger, rates, as_of, pivot, numeric, grains, targets):
    runs = balance_intervals(active, as_of)
    return balances_of_runs(runs, rates, as_of, _targets(targets, rates, ledger, pivot), pivot, numeric, grains)


def balances_of_runs(
    runs: DataFrame, rates: DataFrame, as_of: Column, targets: DataFrame, pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal", grains: list[str] = GRAINS,
) -> DataFrame:
    """Rows of the balance mart for runs of days with one balance (``balance_intervals``)."""
    days = calendar_spine(runs, "valid_from", F.col("valid_to"), "period_end").drop("valid_from", "valid_to")
    # A day that ends several periods is converted once.
    converted = convert_to_targets(
        with_closing_periods(in_own_stage(days, "currency"), "period_end", as_of, grains), rates, targets, "balance",
        F.col("period_end"), "balance_converted", pivot=pivot, numeric=numeric,
    )
    return unpack_periods(converted).select(*_BALANCE_COLUMNS)


def balance_mart(
    ledger: DataFrame,
    rates: DataFrame,
    as_of: Column,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
    grains: list[str] = GRAINS,
    targets: list[str] | None = None,
) -> DataFrame:
    """Balance of every active account at the end of every period up to ``as_of``."""
    return _balance_rows(filter_active(ledger), ledger, rates, as_of, pivot, numeric, grains, targets)


def masked_ledger(
    ledger: DataFrame, accounts: DataFrame, accounts_demo: DataFrame, masks: DataFrame
) -> DataFrame:
    """Active ledger rows with demo accounts and signed scaled amounts."""
    rows = two_hop_dim(filter_active(ledger), accounts, accounts_demo)
    return composite_key_left(rows, masks).select(
        "transaction_ts", F.col("demo_account").alias("account"),
        mask_amount(F.col("amount"), F.col("amount_factor")).alias("amount"), "currency",
        "transaction_type", "is_reserve_account", "is_credit_account",
    )


def balance_mart_masked(
    ledger: DataFrame,
    rates: DataFrame,
    accounts: DataFrame,
    accounts_demo: DataFrame,
    masks: DataFrame,
    as_of: Column,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
    grains: list[str] = GRAINS,
    targets: list[str] | None = None,
) -> DataFrame:
    """As ``balance_mart`` over the masked ledger: every amount is scaled before it is summed."""
    masked = masked_ledger(ledger, accounts, accounts_demo, masks)
    return _balance_rows(masked, ledger, rates, as_of, pivot, numeric, grains, targets)

"""Reads behind the dashboards: one grain and one currency each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_period(facts, shown_type, grain, target_currency, by, out):
    rows = facts.filter(
        (F.col("transaction_type") == shown_type)
        & (F.col("period_grain") == grain)
        & (F.col("target_currency") == target_currency)
    )
    return rows.groupBy("period", *by).agg(
        F.sum("amount_abs_converted").alias(out), F.count("*").alias("transactions")
    )


def spend_by_period(
    facts: DataFrame, grain: str, target_currency: str,
    by: tuple[str, ...] = ("parent_category", "expense_type", "account_type"),
) -> DataFrame:
    """Expenses per period; periods without expenses are absent."""
    return _by_period(facts, "Expense", grain, target_currency, by, "spend")


def income_by_period(
    facts: DataFrame, grain: str, target_currency: str,
    by: tuple[str, ...] = ("parent_category", "account_type"),
) -> DataFrame:
    """Incomes per period; periods without incomes are absent."""
    return _by_period(facts, "Income", grain, target_currency, by, "income")


def balance_over_time(
    balances: DataFrame, grain: str, target_currency: str, by: tuple[str, ...] = ("account_type",)
) -> DataFrame:
    """Balance per period, summed over accounts."""
    rows = balances.filter(
        (F.col("period_grain") == grain) & (F.col("target_currency") == target_currency)
    )
    return rows.groupBy("period", *by).agg(
        F.sum("balance_converted").alias("balance"), F.count("*").alias("accounts")
    )

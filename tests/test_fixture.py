"""Results worked out by hand on the small ledger."""

from collections import Counter
from decimal import Decimal

import fixture as fx
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.targets import target_currency_set
from ledgerloom.plans import marts
from ledgerloom.plans.core import core_rates, core_transactions
from ledgerloom.plans.staging import stg_rates, stg_transactions


@pytest.fixture(scope="module")
def staged(spark):
    return stg_transactions(fx.raw(spark), fx.registry(spark), *fx.SOURCE)


@pytest.fixture(scope="module")
def ledger(spark, staged):
    return core_transactions(staged, fx.accounts(spark), fx.as_of()).cache()


@pytest.fixture(scope="module")
def rates(spark):
    return core_rates(stg_rates(fx.raw_rates(spark))).cache()


@pytest.fixture(scope="module")
def facts(spark, ledger, rates):
    return marts.fact_mart(ledger, rates, fx.tags(spark, ("regular", True)),
                           fx.tags(spark, ("from reserve", True))).cache()


@pytest.fixture(scope="module")
def balances(ledger, rates):
    return marts.balance_mart(ledger, rates, fx.as_of()).cache()


def test_staging(staged, rates):
    rows = staged.orderBy("raw_id").collect()
    assert [r.flow_type for r in rows] == ["income", "expense", "expense", "expense", "zero"]
    assert [r.is_transfer for r in rows] == [False, False, False, True, False]
    assert rows[1].account == "Wallet" and rows[1].currency == "USD"
    assert rows[2].amount == Decimal("-50.00")
    assert Counter((r.base_currency, float(r.rate)) for r in rates.collect()) == Counter(
        [("USD", 90.5), ("USD", 90.6), ("USD", 91.1), ("USD", 92.0), ("KGS", 1.035), ("KGS", 1.05)]
    )


def test_ledger(ledger):
    rows = ledger.collect()
    assert Counter(r.transaction_type for r in rows) == {
        "income": 1, "expense": 2, "transfer_out": 1, "transfer_in": 1, "other": 1,
        "opening_balance": 4,
    }
    leg = next(r for r in rows if r.transaction_type == "transfer_in")
    assert (leg.account, leg.amount, leg.currency) == ("Closed", Decimal("5.00"), "USD")
    assert (leg.transfer_account, leg.transfer_amount, leg.transfer_currency) == (
        "Card", Decimal("-300.00"), "RUB")
    assert sorted(int(r.amount_abs) for r in rows) == [0, 5, 50, 100, 100, 100, 100, 100, 300, 1000]
    assert len({r.transaction_id for r in rows}) == len(rows)


def test_fact_mart_size(ledger, rates, facts):
    targets = {r[0] for r in target_currency_set(rates, ledger).collect()}
    assert targets == {"USD", "KGS", "RUB"}
    assert facts.count() == 7 * 5 * 3
    assert facts.filter("amount_abs_converted IS NULL").count() == 30
    assert facts.filter("account = 'Closed'").count() == 0


def test_fact_mart_labels(facts):
    first = facts.filter("transaction_type = 'Income' AND target_currency = 'USD'")
    assert {r.period_grain: r.period for r in first.collect()} == {
        "Day": "2026-08-01", "Week": "2026-07-27", "Month": "2026-08", "Quarter": "2026-Q3",
        "Year": "2026",
    }
    kinds = facts.filter("transaction_type = 'Expense'").select("account", "expense_type").distinct()
    assert {tuple(r) for r in kinds.collect()} == {
        ("Wallet", "Recurring"), ("Savings", "Reserve-funded")}
    types = facts.select("account", "account_type").distinct().collect()
    assert {tuple(r) for r in types} == {
        ("Wallet", "Standard"), ("Savings", "Reserve"), ("Card", "Credit")}


@pytest.mark.parametrize(("kind", "account", "target", "amount"), [
    ("Income", "Wallet", "USD", "1000"), ("Income", "Wallet", "RUB", "90600"),
    ("Income", "Wallet", "KGS", "87536.231884"),
    ("Expense", "Wallet", "RUB", "9060"), ("Expense", "Wallet", "KGS", "8753.623188"),
    ("Expense", "Savings", "RUB", "4530"), ("Expense", "Savings", "KGS", "4376.811594"),
    ("Transfer out", "Card", "USD", "3.293085"), ("Transfer out", "Card", "KGS", "289.855072"),
])
def test_conversions(facts, kind, account, target, amount):
    rows = facts.filter(
        (F.col("transaction_type") == kind) & (F.col("account") == account)
        & (F.col("target_currency") == target) & (F.col("period_grain") == "Day")
    ).collect()
    assert [r.amount_abs_converted for r in rows] == [Decimal(amount).quantize(Decimal("1e-6"))]


def test_balance_mart(balances):
    counts = balances.groupBy("account", "period_grain").count().collect()
    assert {(r.account, r.period_grain): r["count"] for r in counts} == {
        (a, g): n * 3
        for a, ns in {"Wallet": (5356, 766, 176, 59, 15), "Savings": (4900, 701, 161, 54, 14),
                      "Card": (3348, 480, 110, 37, 10)}.items()
        for g, n in zip(("Day", "Week", "Month", "Quarter", "Year"), ns)
    }
    last = balances.filter("period_grain = 'Year' AND period = '2026'").collect()
    assert {str(r.period_end) for r in last} == {"2026-08-31"}
    got = {(r.account, r.target_currency): r.balance_converted for r in last}
    want = {
        ("Wallet", "USD"): "1000", ("Savings", "USD"): "50", ("Card", "RUB"): "-200",
        ("Wallet", "RUB"): "92000", ("Wallet", "KGS"): "87619.047619",
        ("Savings", "RUB"): "4600", ("Savings", "KGS"): "4380.952381",
        ("Card", "USD"): "-2.173913", ("Card", "KGS"): "-190.476190",
    }
    assert got == {k: Decimal(v).quantize(Decimal("1e-6")) for k, v in want.items()}


def test_balance_is_the_sum_of_amounts(ledger, balances):
    sums = ledger.filter("is_active_account").groupBy("account").agg(F.sum("amount").alias("s"))
    ends = balances.filter("period_grain = 'Day' AND period = '2026-08-31' "
                           "AND target_currency = 'RUB'")
    assert {r.account: r.balance for r in ends.collect()} == {
        r.account: r.s for r in sums.collect()}


def test_masked_twins_without_masks_agree(spark, ledger, rates, facts, balances):
    names = fx.accounts(spark)
    pairs = ledger.select(
        F.col("parent_category").alias("real_parent_category"),
        F.col("category").alias("real_category"),
        F.col("parent_category").alias("demo_parent_category"),
        F.col("category").alias("demo_category"),
        F.lit(1).cast("decimal(18,6)").alias("amount_factor"),
    ).dropna().distinct()
    masked = marts.fact_mart_masked(
        ledger, rates, fx.tags(spark, ("regular", True)), fx.tags(spark, ("from reserve", True)),
        names, names, pairs)
    plain = facts.withColumns({"tags": F.lit(None), "note": F.lit(None)})
    assert Counter(masked.collect()) == Counter(plain.collect())
    twin = marts.balance_mart_masked(ledger, rates, names, names, pairs, fx.as_of())
    assert twin.exceptAll(balances).isEmpty() and balances.exceptAll(twin).isEmpty()

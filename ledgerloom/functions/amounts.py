"""Signs, types, rates, conversion and masking of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import CONVERTED, PIVOT_CURRENCY, RATE


def flow_type(amount: Column) -> Column:
    """Sign of an amount as a word; a missing amount counts as zero."""
    return F.when(amount < 0, "expense").when(amount > 0, "income").otherwise("zero")


def is_transfer(account: Column, amount: Column) -> Column:
    """A row is a transfer once it names a counter account or a counter amount."""
    return account.isNotNull() | amount.isNotNull()


def unit_rate(quote: Column, base: Column) -> Column:
    """Price of one unit; NULL without a base or with base zero."""
    return (quote / F.nullif(base, F.lit(0).cast("decimal(18,6)"))).cast(RATE)


def amount_abs(amount: Column, flow: Column) -> Column:
    """Incomes and openings keep their sign, everything else loses it."""
    return F.when(flow.isin("income", "opening_balance"), amount).otherwise(F.abs(amount))


def ledger_type(flow: Column, transfer: Column) -> Column:
    """The transfer leg decides first, then the flow; whatever is left is ``other``."""
    by_flow = F.when(flow.isin("expense", "income", "opening_balance"), flow).otherwise("other")
    return F.when(transfer.isin("transfer_out", "transfer_in"), transfer).otherwise(by_flow)


def pivot_amount(
    amount: Column, currency: Column, currency_rate: Column, pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
) -> Column:
    """Amount in the pivot currency, not rounded; NULL without a rate."""
    if numeric == "double":
        amount, currency_rate, exact = amount.cast("double"), currency_rate.cast("double"), "double"
    else:
        amount, currency_rate = amount.cast("decimal(18,2)"), currency_rate.cast("decimal(19,12)")
        exact = "decimal(38,14)"
    # Both branches have one type, so neither is rounded to fit the other.
    return F.when(currency == pivot, amount.cast(exact)).otherwise((amount * currency_rate).cast(exact))


def rate_divisor(rate: Column, numeric: str = "decimal") -> Column:
    """A rate to divide by; NULL if it is zero."""
    kind = "double" if numeric == "double" else "decimal(19,12)"
    return F.nullif(rate.cast(kind), F.lit(0).cast(kind))


def millionths(in_pivot: Column) -> Column:
    """Nearly the amount in the pivot currency, in millionths, as a binary number."""
    return in_pivot.cast("double") * 1e6


def _quotient(dividend: Column, divisor: Column, near: tuple[Column, Column] | None) -> Column:
    """Decimal quotient with six digits, rounded half away from zero.

    ``near`` holds both sides as binary numbers, the dividend in millionths. Their quotient is off by
    less than 2e-15 of itself; where that cannot change the whole number next to it, that one is taken
    and the long division is left out.
    """
    exact = (dividend / divisor).cast(CONVERTED)
    if near is None:
        return exact
    guess = near[0] / near[1]
    whole = F.rint(guess)
    sure = F.abs(guess - whole) + F.abs(guess) * 2e-15 < 0.5
    # Sure of less than 2.5e14 only. So many microseconds are, as decimal seconds, so many millionths, and no
    # decimal numbers are multiplied for that.
    taken = F.expr("INTERVAL '0.000001' SECOND") * whole.cast("long")
    return F.when(sure, taken.cast(CONVERTED)).otherwise(exact)


def target_amount(
    amount: Column,
    in_pivot: Column,
    currency: Column,
    target: Column,
    divisor: Column,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
    near: tuple[Column, Column] | None = None,
) -> Column:
    """Amount in a target currency from that in the pivot currency (``pivot_amount``) and the target's
    rate (``rate_divisor``)."""
    if numeric == "double":
        amount, result = amount.cast("double"), "double"
        quotient = in_pivot / divisor
    else:
        amount, result = amount.cast("decimal(18,2)"), CONVERTED
        quotient = _quotient(in_pivot, divisor, near)
    return (
        F.when(currency == target, amount.cast(result))
        .when(target == pivot, in_pivot.cast(result))
        .otherwise(quotient)
    )


def convert_amount(
    amount: Column,
    currency: Column,
    target: Column,
    currency_rate: Column,
    target_rate: Column,
    pivot: str = PIVOT_CURRENCY,
    numeric: str = "decimal",
) -> Column:
    """Convert through the pivot currency; NULL wherever a needed rate is missing or zero.

    Decimal results are exact: amounts of up to 16 and rates of up to 7 digits before the point
    give a product that fits whole, and the quotient is rounded once, half away from zero. A
    value with more digits is an error. ``numeric="double"`` computes in binary floating point.
    """
    in_pivot = pivot_amount(amount, currency, currency_rate, pivot, numeric)
    divisor = rate_divisor(target_rate, numeric)
    return target_amount(amount, in_pivot, currency, target, divisor, pivot, numeric)


def mask_amount(amount: Column, factor: Column, absolute: bool = False) -> Column:
    """Scale by a factor (1 where none is known), to cents, half away from zero."""
    masked = F.round(amount * F.coalesce(factor, F.lit(1).cast("decimal(18,6)")), 2)
    return (F.abs(masked) if absolute else masked).cast("decimal(18,2)")

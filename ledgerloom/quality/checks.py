"""Checks as DataFrame -> failing rows; no rows means the check passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import any_missing
from ledgerloom.operators.batches import filter_active
from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.keyed import (
    distinct_count_over, duplicate_keys, global_having, missing_in_dim, split_to_rows,
)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held more than once; NULLs are not compared."""
    return duplicate_keys(df.filter(F.col(column).isNotNull()), [column])


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows with another value; NULL passes."""
    return df.filter(~F.col(column).isin(values))


def relationships(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, where: str | None = None
) -> DataFrame:
    """Rows whose value has no parent; NULL passes, ``where`` narrows the rows checked."""
    rows = (df.filter(where) if where else df).filter(F.col(column).isNotNull())
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return lookup_join(rows, known, [column], "left_anti")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations held more than once; NULLs are compared."""
    return duplicate_keys(df, columns)


def positive(df: DataFrame, column: str) -> DataFrame:
    """Rows at or below zero; NULL passes."""
    return df.filter(F.col(column) <= 0)


def active_tags_exist(dictionary: DataFrame, raw: DataFrame, tags: str = "tags") -> DataFrame:
    """Active dictionary tags found on no row; tags are separated by a comma and trimmed."""
    seen = split_to_rows(raw, tags, "tag")
    wanted = filter_active(dictionary, "is_active").select(F.btrim("tag").alias("tag")) \
        .filter(F.col("tag") != "")
    return wanted.join(seen, "tag", "left_anti")


def accounts_in_dim(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Ledger accounts the account dimension does not know."""
    missing = missing_in_dim(ledger, accounts, {"account": "account_name"})
    return missing.select(F.col("account").alias("account_name"))


def single_currency(ledger: DataFrame) -> DataFrame:
    """Active accounts with bookings in more than one currency."""
    return distinct_count_over(filter_active(ledger), "account", "currency",
                               count="currency_count")


def max_one_active(dictionary: DataFrame) -> DataFrame:
    """One row if a tag dictionary has more than one active entry."""
    return global_having(filter_active(dictionary, "is_active"), count="active_row_count")


def mapping_coverage(ledger: DataFrame, masks: DataFrame) -> DataFrame:
    """Category pairs of the ledger without a mask."""
    return missing_in_dim(ledger, masks, {
        "parent_category": "real_parent_category", "category": "real_category",
    })


def mapping_unique(masks: DataFrame) -> DataFrame:
    """Category pairs with more than one mask."""
    return duplicate_keys(masks, ["real_parent_category", "real_category"], "mapping_count")


def mapping_required(masks: DataFrame) -> DataFrame:
    """Masks with a blank name or without a factor."""
    names = ["real_parent_category", "real_category", "demo_parent_category", "demo_category"]
    return masks.filter(any_missing([F.col(n) for n in names], [F.col("amount_factor")]))

"""Run many checks at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.quality import checks
from ledgerloom.schemas import (
    ACCOUNT_TYPES, DISPLAY_TYPES, EXPENSE_TYPES, FRESHNESS_STATUSES, GRAINS, LEDGER_TYPES,
    VOLUME_STATUSES,
)

# Severity of a layer's checks unless a check says otherwise.
LAYER_SEVERITY = {"stg": "warn", "core": "error", "dm": "warn", "dm_demo": "warn",
                  "infra": "warn", "seed": "error", "demo": "error"}


@dataclass
class Suite:
    """Checks by table. Row checks of one table are counted in a single pass over it, and so are
    all checks for repeated keys, with one shuffle."""

    rows: list[tuple[str, DataFrame, str, str, Column]] = field(default_factory=list)
    repeats: list[tuple[str, DataFrame, str, str, list[str], bool]] = field(default_factory=list)
    keys: list[tuple[str, str, str, DataFrame]] = field(default_factory=list)

    def _severity(self, model: str, severity: str | None) -> str:
        layers = [layer for layer in LAYER_SEVERITY if model.startswith(layer + "_")]
        return severity or LAYER_SEVERITY[max(layers, key=len)]

    def row(self, model: str, df: DataFrame, name: str, fails: Column, severity=None) -> Suite:
        """A check that looks at one row at a time; ``fails`` is true for a failing row."""
        self.rows.append((model, df, name, self._severity(model, severity), fails))
        return self

    def key(self, model: str, name: str, failing: DataFrame, severity=None) -> Suite:
        """A check that needs its own job and gives failing rows."""
        self.keys.append((model, name, self._severity(model, severity), failing))
        return self

    def not_null(self, model: str, df: DataFrame, *columns: str) -> Suite:
        for c in columns:
            self.row(model, df, f"not_null_{c}", F.col(c).isNull())
        return self

    def accepted(self, model: str, df: DataFrame, column: str, values: list[str]) -> Suite:
        return self.row(model, df, f"accepted_values_{column}", ~F.col(column).isin(values))

    def positive(self, model: str, df: DataFrame, *columns: str) -> Suite:
        for c in columns:
            self.row(model, df, f"positive_{c}", F.col(c) <= 0)
        return self

    def unique(self, model: str, df: DataFrame, *columns: str) -> Suite:
        for c in columns:
            self.repeats.append((model, df, f"unique_{c}", self._severity(model, None), [c], False))
        return self

    def unique_combination(self, model: str, df: DataFrame, columns: list[str]) -> Suite:
        self.repeats.append((model, df, "unique_combination", self._severity(model, None), columns, True))
        return self

    def related(self, model: str, df: DataFrame, name: str, column: str, parent: DataFrame, parent_column: str,
                where: str, max_inline: int = 500) -> Suite:
        """Values need a parent where ``where`` holds. Few parents are looked up in the pass over the rows."""
        found = parent.select(parent_column).distinct().limit(max_inline + 1).collect()
        if len(found) > max_inline:
            return self.key(model, name, checks.relationships(df, column, parent, parent_column, where))
        known = [r[0] for r in found if r[0] is not None]
        return self.row(model, df, name, F.expr(where) & ~F.col(column).isin(known))

    def run(self) -> DataFrame:
        """One row per check: model_name, test_name, severity, failures, status."""
        counted = []
        for model, df in {(m, id(d)): (m, d) for m, d, *_ in self.rows}.values():
            own = [(n, s, f) for m, d, n, s, f in self.rows if m == model and d is df]
            counts = df.agg(*(
                F.count_if(fails).alias(f"_{i}") for i, (_, _, fails) in enumerate(own)
            ))
            results = F.explode(F.array(*(
                F.struct(F.lit(name).alias("test_name"), F.lit(severity).alias("severity"),
                         F.col(f"_{i}").alias("failures"))
                for i, (name, severity, _) in enumerate(own)
            )))
            counted.append(counts.select(F.lit(model).alias("model_name"), results.alias("r"))
                           .select("model_name", "r.*"))
        for df in {id(d): d for _, d, *_ in self.repeats}.values():
            counted.append(_repeated([r for r in self.repeats if r[1] is df], df))
        for model, name, severity, failing in self.keys:
            counted.append(failing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(model).alias("model_name"), F.lit(name).alias("test_name"),
                F.lit(severity).alias("severity"), "failures",
            ))
        status = F.when(F.col("failures") == 0, "pass") \
            .when(F.col("severity") == "error", "fail").otherwise("warn")
        return reduce(DataFrame.unionByName, counted).withColumn("status", status)


def _key_hash(columns: list[str]) -> list[Column]:
    """128 bits that stand for the values of some columns and for which of them are NULL. That two keys
    among 10^12 have one hash has a probability of about 10^-15."""
    missing = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    return [F.xxhash64(F.lit(seed), missing, *columns) for seed in (1, 2)]


def _repeated(own: list[tuple], df: DataFrame) -> DataFrame:
    """How many keys each check finds more than once. Each row gives one hash per check, and hashes are
    counted before and after one shuffle of all of them."""
    keys = F.array_compact(F.array(*(
        F.when(F.lit(True) if with_nulls else F.col(columns[0]).isNotNull(),
               F.struct(F.lit(i).alias("check"), *(h.alias(n) for h, n in zip(_key_hash(columns), ("h1", "h2")))))
        for i, (_, _, _, _, columns, with_nulls) in enumerate(own)
    )))
    counts = df.select(F.explode(keys).alias("key")).groupBy("key.check", "key.h1", "key.h2") \
        .agg(F.count("*").alias("n")).filter("n > 1") \
        .agg(*(F.count_if(F.col("check") == i).alias(f"_{i}") for i in range(len(own))))
    results = F.explode(F.array(*(
        F.struct(F.lit(model).alias("model_name"), F.lit(name).alias("test_name"),
                 F.lit(severity).alias("severity"), F.col(f"_{i}").alias("failures"))
        for i, (model, _, name, severity, *_) in enumerate(own)
    )))
    return counts.select(results.alias("r")).select("r.*")


def enforce(results: DataFrame) -> None:
    """Fail if any check of severity error failed. There is one result row per check."""
    failed = results.filter(F.col("status") == "fail").orderBy("model_name", "test_name").collect()
    if failed:
        lines = [f"{r.model_name}.{r.test_name}: {r.failures} failing rows" for r in failed]
        raise ValueError("checks failed: " + "; ".join(lines))


def log_results(
    results: DataFrame, target: str, invocation: str, as_of: Column, seconds: float | None = None
) -> DataFrame:
    """Results in the shape of the result history: key (target, invocation, unique_id).

    ``seconds`` is what the run of all these checks took; they run in one pass per table.
    """
    message = F.when(F.col("failures") > 0, F.concat(F.col("failures").cast("string"), F.lit(" failing rows")))
    return results.select(
        F.lit(target).alias("target_name"),
        F.lit(invocation).alias("invocation_id"),
        F.concat_ws(".", "model_name", "test_name").alias("unique_id"),
        "test_name",
        F.col("model_name").alias("model_unique_id"),
        "status", "severity", "failures",
        F.lit(seconds).cast("decimal(18,3)").alias("execution_time_s"), message.alias("message"),
        as_of.cast("timestamp").alias("logged_at"),
    )


def staging_checks(suite: Suite, transactions: DataFrame, rates: DataFrame) -> Suite:
    """Checks of the staging layer."""
    t, r = "stg_fact_transaction", "stg_exchange_rate"
    suite.unique_combination(t, transactions, [
        "source_number", "transaction_date", "account", "amount", "currency",
        "transfer_account", "transfer_amount", "transfer_currency",
    ])
    suite.unique(t, transactions, "raw_id")
    suite.not_null(t, transactions, "raw_id", "transaction_date", "account", "amount", "currency",
                   "ingested_at", "ingested_by", "source_file", "ingestion_id", "flow_type",
                   "is_transfer")
    suite.accepted(t, transactions, "flow_type", ["income", "expense", "zero"])
    return _rate_checks(suite, r, rates)


def _rate_checks(suite: Suite, model: str, rates: DataFrame) -> Suite:
    suite.unique_combination(model, rates, ["base_currency", "rate_date"])
    suite.unique(model, rates, "raw_id")
    columns = ["raw_id", "source", "rate_date", "base_currency", "quote_currency", "rate"]
    if model.startswith("stg"):
        columns += ["source_rate_key", "base_amount", "quote_amount", "ingested_at", "ingested_by"]
        suite.positive(model, rates, "base_amount", "quote_amount")
    suite.not_null(model, rates, *columns)
    suite.positive(model, rates, "rate")
    return suite.accepted(model, rates, "source", ["cbr"])


def core_checks(
    suite: Suite, ledger: DataFrame, rates: DataFrame, accounts: DataFrame
) -> Suite:
    """Checks of the canonical layer."""
    t = "core_fact_transaction"
    suite.unique(t, ledger, "transaction_id")
    suite.not_null(t, ledger, "transaction_id", "transaction_ts", "account", "currency",
                   "amount_abs", "transaction_type", "ingested_at", "source_file")
    suite.accepted(t, ledger, "transaction_type", LEDGER_TYPES)
    suite.key(t, "accounts_exist_in_dim_accounts", checks.accounts_in_dim(ledger, accounts))
    suite.key(t, "accounts_have_single_currency", checks.single_currency(ledger))
    return _rate_checks(suite, "core_exchange_rate", rates)


def seed_checks(
    suite: Suite, accounts: DataFrame, dictionaries: dict[str, DataFrame], raw: DataFrame,
    model: str = "seed_dim_accounts",
) -> Suite:
    """Checks of reference data: accounts and tag dictionaries."""
    suite.unique(model, accounts, "account_id", "account_name")
    suite.not_null(model, accounts, *accounts.columns)
    for name, dictionary in dictionaries.items():
        tags = f"seed_{name}"
        suite.unique(tags, dictionary, "tag")
        suite.not_null(tags, dictionary, "tag", "is_active")
        suite.key(tags, "active_tags_exist_in_raw", checks.active_tags_exist(dictionary, raw),
                  severity="warn")
        suite.key(tags, "at_most_one_active_row", checks.max_one_active(dictionary))
    return suite


def mart_checks(
    suite: Suite, facts: DataFrame, balances: DataFrame, rates: DataFrame, layer: str = "dm",
    pivot: str = "RUB",
) -> Suite:
    """Checks of the fact and balance marts, or of their masked twins."""
    f, b = f"{layer}_fact_transaction", f"{layer}_account_balance"
    named = ["account"] if layer == "dm_demo" else []
    suite.not_null(f, facts, "transaction_date", "currency", "period_grain", "period",
                   "target_currency", *named)
    suite.accepted(f, facts, "transaction_type", list(DISPLAY_TYPES.values()))
    suite.accepted(f, facts, "expense_type", EXPENSE_TYPES)
    suite.not_null(b, balances, "account", "account_type", "period_grain", "period", "period_end",
                   "currency", "balance", "target_currency")
    suite.unique_combination(b, balances, ["account", "period_grain", "period", "target_currency"])
    for model, df in ((f, facts), (b, balances)):
        suite.accepted(model, df, "account_type", ACCOUNT_TYPES)
        suite.accepted(model, df, "period_grain", GRAINS)
        suite.related(model, df, "relationships_currency", "currency", rates, "base_currency",
                      f"currency != '{pivot}'")
    return suite


def mask_checks(suite: Suite, ledger: DataFrame, masks: DataFrame) -> Suite:
    """Checks of the category masks."""
    model = "demo_category_mapping"
    suite.key(model, "categories_are_mapped", checks.mapping_coverage(ledger, masks))
    suite.key(model, "unique_real_categories", checks.mapping_unique(masks))
    return suite.key(model, "required_values", checks.mapping_required(masks))


def monitoring_checks(suite: Suite, freshness: DataFrame, volume: DataFrame) -> Suite:
    """Checks of the monitoring tables."""
    for model, df, column, values in (
        ("infra_data_quality_freshness", freshness, "freshness_status", FRESHNESS_STATUSES),
        ("infra_data_volume_monitoring", volume, "volume_status", VOLUME_STATUSES),
    ):
        suite.not_null(model, df, column)
        suite.accepted(model, df, column, values)
    return suite

"""Registered joins, aggregates, windows and set operations (C, D, E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog import derived, oracle
from ledgerloom.catalog.derived import SOURCE, Tables
from ledgerloom.catalog.marts import BASELINE, RANKED
from ledgerloom.catalog.registry import query
from ledgerloom.operators import asof, balances, keyed, ledger, loads, masking, periods, tags
from ledgerloom.operators.batches import filter_active, latest_batch
from ledgerloom.operators.targets import cross_targets, target_currency_set

# --- joins ---


@query("latest_batch", """
    SELECT raw_id, ingestion_id, account FROM raw_transactions WHERE ingestion_id = 2
""")
def newest_batch(t: Tables):
    rows = latest_batch(t.raw_transactions, t.ledger_registry, *SOURCE)
    return rows.select("raw_id", "ingestion_id", "account")


@query("enrich_accounts", """
    SELECT raw_id, account, is_active AS is_active_account, is_reserve AS is_reserve_account,
           is_credit AS is_credit_account
    FROM staged LEFT JOIN dim_accounts ON account_name = account
""")
def enrich_accounts(t: Tables):
    return ledger.enrich_accounts(t.staged().select("raw_id", "account"), t.dim_accounts)


@query("tag_membership_join", """
    SELECT raw_id, tags, tag IS NOT NULL AS is_tagged
    FROM staged LEFT JOIN many_tags ON is_active AND list_contains(str_split(tags, ', '), tag)
""")
def tag_membership_join(t: Tables):
    rows = t.staged().select("raw_id", "tags")
    return tags.tag_membership_join(rows, t.many_tags, "is_tagged")


@query("tag_flags", """
    SELECT raw_id, tags, EXISTS (SELECT 1 FROM many_tags WHERE is_active
        AND list_contains(str_split(tags, ', '), tag)) AS is_tagged FROM staged
""")
def tag_flags(t: Tables):
    return tags.tag_flags(t.staged().select("raw_id", "tags"), t.many_tags, "is_tagged")


@query("two_hop_dim", """
    SELECT raw_id, account, e.account_name AS demo_account FROM staged
    LEFT JOIN dim_accounts AS d ON d.account_name = account
    LEFT JOIN dim_accounts_demo AS e ON e.account_id = d.account_id
""")
def two_hop_dim(t: Tables):
    rows = t.staged().select("raw_id", "account")
    return masking.two_hop_dim(rows, t.dim_accounts, t.dim_accounts_demo)


@query("composite_key_left", """
    SELECT raw_id, parent_category, category, demo_parent_category, demo_category, amount_factor
    FROM staged LEFT JOIN category_mask
        ON real_parent_category = parent_category AND real_category = category
""")
def composite_key_left(t: Tables):
    rows = t.staged().select("raw_id", "parent_category", "category")
    return masking.composite_key_left(rows, t.category_mask)


@query("cross_targets", """
    SELECT raw_id, currency, target_currency FROM staged CROSS JOIN targets
""")
def fan_out(t: Tables):
    targets = target_currency_set(t.staged_rates(), t.ledger())
    return cross_targets(t.staged().select("raw_id", "currency"), targets)


@query("cross_targets_bucketed", """
    SELECT raw_id, currency, target_currency FROM staged CROSS JOIN targets
""")
def fan_out_bucketed(t: Tables):
    targets = target_currency_set(t.staged_rates(), t.ledger())
    return cross_targets(t.staged().select("raw_id", "currency"), targets, max_inline_targets=0,
                         buckets=4, salts=4)


@query("account_day_spine", "SELECT account, currency, snapshot_date FROM spine")
def account_day_spine(t: Tables):
    bounds = balances.account_bounds(filter_active(t.ledger()))
    return balances.account_day_spine(bounds, t.as_of).select("account", "currency", "snapshot_date")


_ASOF = """
    SELECT f.raw_id, f.currency, f.transaction_date, o.rate
    FROM staged AS f ASOF LEFT JOIN (SELECT base_currency, rate_date, exact_rate AS rate
                                     FROM rate_points) AS o
        ON o.base_currency = f.currency AND o.rate_date <= f.transaction_date
"""


def _asof(strategy: str, **options):
    def build(t: Tables):
        rates = t.staged_rates().withColumnRenamed("base_currency", "currency")
        rows = t.staged().select("raw_id", "currency", "transaction_date")
        return asof.asof_join(rows, rates, ["currency"], "transaction_date", "rate_date", ["rate"],
                              strategy=strategy, tie_break="raw_id", **options)

    return build


for _name, _strategy in (("asof_rate_join", "auto"), ("asof_rate_join_interval", "interval"),
                         ("asof_rate_join_dense", "dense"), ("asof_rate_join_union", "union")):
    query(_name, _ASOF)(_asof(_strategy))
query("asof_rate_join_interval_shuffled", _ASOF)(_asof("interval", max_broadcast_rows=0))


@query("lateral_unpivot", f"""
    SELECT o_orderkey, period_grain, {oracle.period('o_orderdate')} AS period
    FROM orders CROSS JOIN (SELECT unnest({oracle.GRAINS}) AS period_grain)
""")
def lateral_unpivot(t: Tables):
    rows = t.given("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return periods.lateral_unpivot(rows, F.col("day")).drop("day")


@query("spine_left_totals", """
    SELECT s.account, s.snapshot_date,
           CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS day_amount
    FROM spine AS s LEFT JOIN active AS a ON a.account = s.account
        AND CAST(a.transaction_ts AS DATE) = s.snapshot_date
    GROUP BY s.account, s.snapshot_date
""")
def spine_left_totals(t: Tables):
    active = filter_active(t.stored_ledger())
    spine = balances.account_day_spine(balances.account_bounds(active), t.as_of)
    return balances.spine_left_totals(spine, balances.daily_totals(active)).select(
        "account", "snapshot_date", "day_amount"
    )


@query("missing_in_dim", """
    SELECT DISTINCT parent_category, category FROM staged
    WHERE (parent_category, category) NOT IN
        (SELECT (real_parent_category, real_category) FROM category_mask)
""")
def missing_in_dim(t: Tables):
    return keyed.missing_in_dim(t.staged(), t.category_mask, {
        "parent_category": "real_parent_category", "category": "real_category",
    })


@query("else_default_row", """
    SELECT event_id, event_type, value, 'filled' AS kind FROM events WHERE value >= 0
    UNION ALL SELECT event_id, event_type, value, 'bare' FROM events WHERE value < 0
    UNION ALL SELECT NULL, 'none', NULL, kind FROM
        (SELECT count(*) FILTER (value >= 0) AS n, 'filled' AS kind FROM events
         UNION ALL SELECT count(*) FILTER (value < 0), 'bare' FROM events)
    WHERE n = 0
""")
def else_default_row(t: Tables):
    rows = t.given("events").select("event_id", "event_type", "value")
    kinds = [keyed.else_default_row(rows.filter(where), {"event_type": F.lit("none")})
             .withColumn("kind", F.lit(kind)) for kind, where in (("filled", "value >= 0"), ("bare", "value < 0"))]
    return kinds[0].unionByName(kinds[1])


def _loaded(t: Tables):
    return t.load_registry.filter(F.col("status") == "loaded")


@query("latest_vs_baseline", f"""
    SELECT source_object, ingestion_id, rows_loaded, baseline_load_count, avg_rows_loaded
    FROM (SELECT * FROM ({RANKED}) WHERE load_rank = 1)
    LEFT JOIN ({BASELINE}) USING (source_system, source_object, raw_table)
""")
def latest_vs_baseline(t: Tables):
    ranked = loads.load_rank(_loaded(t), upto=8)
    return loads.latest_vs_baseline(ranked, loads.baseline_stats(ranked)).select(
        "source_object", "ingestion_id", "rows_loaded", "baseline_load_count", "avg_rows_loaded"
    )


# --- aggregates ---


@query("account_bounds", "SELECT * FROM bounds")
def account_bounds(t: Tables):
    return balances.account_bounds(filter_active(t.ledger()))


@query("daily_totals", """
    SELECT account, CAST(transaction_ts AS DATE) AS snapshot_date,
           CAST(sum(amount) AS DECIMAL(38,2)) AS day_amount FROM active GROUP BY ALL
""")
def daily_totals(t: Tables):
    return balances.daily_totals(filter_active(t.ledger()))


@query("spine_bounds", f"""
    SELECT min(balance_start_date) AS spine_start, DATE '{derived.AS_OF}' AS spine_end FROM bounds
""")
def spine_bounds(t: Tables):
    return balances.spine_bounds(balances.account_bounds(filter_active(t.ledger())), t.as_of)


@query("baseline_stats", BASELINE)
def baseline_stats(t: Tables):
    return loads.baseline_stats(loads.load_rank(_loaded(t), upto=8))


@query("count_distinct_having", """
    SELECT account, count(DISTINCT currency) AS distinct_count FROM staged
    GROUP BY account HAVING distinct_count > 1
""")
def count_distinct_having(t: Tables):
    return keyed.distinct_count_over(t.staged(), "account", "currency")


@query("dup_keys", """
    SELECT account, subcategory, CAST(transaction_date AS DATE) AS day, count(*) AS n_records
    FROM staged GROUP BY ALL HAVING n_records > 1
""")
def dup_keys(t: Tables):
    rows = t.staged().withColumn("day", F.col("transaction_date").cast("date"))
    return keyed.duplicate_keys(rows, ["account", "subcategory", "day"])


@query("global_having", "SELECT count(*) AS row_count FROM staged HAVING row_count > 1")
def global_having(t: Tables):
    return keyed.global_having(t.staged())


@query("distinct_values", "SELECT DISTINCT currency, transfer_currency FROM staged")
def distinct_values(t: Tables):
    return t.staged().select("currency", "transfer_currency").distinct()


# --- windows ---


@query("running_balance", """
    SELECT account, snapshot_date, CAST(balance AS DECIMAL(38,2)) AS balance FROM daily
""")
def running_balance(t: Tables):
    active = filter_active(t.stored_ledger())
    spine = balances.account_day_spine(balances.account_bounds(active), t.as_of)
    days = balances.spine_left_totals(spine, balances.daily_totals(active))
    return balances.running_balance(days).select("account", "snapshot_date", "balance")


@query("daily_balances", """
    SELECT account, currency, account_type, snapshot_date AS period_end,
           CAST(balance AS DECIMAL(38,2)) AS balance FROM daily
""")
def daily_balances(t: Tables):
    return balances.daily_balances(filter_active(t.ledger()), t.as_of)


@query("period_end_snapshot", """
    SELECT account, period_grain, period, period_end, CAST(balance AS DECIMAL(38,2)) AS balance
    FROM snapshots
""")
def period_end_snapshot(t: Tables):
    days = balances.daily_balances(filter_active(t.ledger()), t.as_of)
    days = days.withColumnRenamed("period_end", "snapshot_date")
    return periods.period_end_snapshot(days, ["account"], "snapshot_date", ["balance"])


@query("period_ends", """
    SELECT account, period_grain, period, period_end, CAST(balance AS DECIMAL(38,2)) AS balance
    FROM snapshots
""")
def period_ends(t: Tables):
    days = balances.daily_balances(filter_active(t.ledger()), t.as_of)
    return periods.period_ends(days, "period_end", t.as_of).select(
        "account", "period_grain", "period", "period_end", "balance"
    )


@query("load_rank", RANKED)
def load_rank(t: Tables):
    return loads.load_rank(_loaded(t))


@query("load_rank_first", f"SELECT * FROM ({RANKED}) WHERE load_rank <= 8")
def load_rank_first(t: Tables):
    return loads.load_rank(_loaded(t), upto=8)


@query("rate_intervals", """
    SELECT base_currency, rate_date, exact_rate AS rate,
           lead(rate_date) OVER (PARTITION BY base_currency ORDER BY rate_date) AS valid_to
    FROM rate_points
""")
def rate_intervals(t: Tables):
    points = asof.rate_points(t.staged_rates())
    return asof.validity_intervals(points, ["base_currency"], "rate_date")


# --- sorts, limits, set operations ---


@query("last_successful_load", """
    SELECT ingestion_id, source_object, finished_at, rows_loaded FROM load_registry
    WHERE status = 'loaded' ORDER BY finished_at DESC NULLS FIRST, ingestion_id DESC LIMIT 1
""")
def last_successful_load(t: Tables):
    return loads.last_successful_load(t.load_registry).select(
        "ingestion_id", "source_object", "finished_at", "rows_loaded"
    )


@query("top1_per_key", """
    SELECT base_currency, max(rate_date) AS rate_date, arg_max(raw_id, rate_date) AS raw_id
    FROM staged_rates WHERE rate_date IS NOT NULL GROUP BY base_currency
""")
def top1_per_key(t: Tables):
    dated = t.staged_rates().filter(F.col("rate_date").isNotNull())
    return asof.latest_per_key(dated, ["base_currency"], ["rate_date", "raw_id"],
                               ["rate_date", "raw_id"])


_LEG = ("source_number, transaction_ts, account, amount, currency, transfer_account, "
        "transfer_amount, transfer_currency, transfer_type, note")


def _core_input(t: Tables):
    return t.staged().withColumnRenamed("transaction_date", "transaction_ts").withColumn(
        "transfer_type", F.when(F.col("is_transfer"), "transfer_out")
    ).drop("raw_id", "is_transfer")


@query("union_openings", """
    SELECT source_number, transaction_date AS transaction_ts, account, amount, currency,
           flow_type, source_file FROM staged
    UNION ALL SELECT source_number, transaction_ts, account, amount, currency, flow_type,
           source_file FROM openings
""")
def union_openings(t: Tables):
    return ledger.union_openings(_core_input(t), t.dim_accounts, t.as_of).select(
        "source_number", "transaction_ts", "account", "amount", "currency", "flow_type",
        "source_file",
    )


@query("expand_transfers", f"SELECT {_LEG} FROM legs WHERE flow_type <> 'opening_balance'")
def expand_transfers(t: Tables):
    return ledger.expand_transfers(_core_input(t)).select(*_LEG.split(", "))


@query("target_currency_set", "SELECT target_currency FROM targets")
def target_currencies(t: Tables):
    return target_currency_set(t.staged_rates(), t.ledger())


@query("calendar_spine", f"""
    SELECT account_id, CAST(unnest(generate_series(opening_date, DATE '{derived.AS_OF}',
                                                   INTERVAL 1 DAY)) AS DATE) AS day
    FROM dim_accounts
""")
def calendar_spine(t: Tables):
    return periods.calendar_spine(t.dim_accounts, "opening_date", t.as_of, "day") \
        .select("account_id", "day")


@query("split_to_rows", """
    SELECT DISTINCT trim(unnest(str_split(tags, ','))) AS tag FROM raw_transactions
    WHERE trim(tags) <> ''
""")
def split_to_rows(t: Tables):
    return keyed.split_to_rows(t.raw_transactions, "tags", "tag")

"""Edge cases, other ways behind size checks, and brute-force comparisons."""

import re
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal, localcontext
from types import SimpleNamespace

import fixture as fx
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import amounts, labels, text
from ledgerloom.operators import asof, balances, joins, loads, periods, tags
from ledgerloom.operators.conversion import convert_to_targets
from ledgerloom.operators.targets import cross_targets
from ledgerloom.plans import marts, monitoring
from ledgerloom.plans.core import core_rates, core_transactions
from ledgerloom.plans.staging import quarantine, stg_rates, stg_transactions, typed_transactions
from ledgerloom.quality import checks, suite
from ledgerloom.schemas import FILE_REGISTRY, MONEY


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize(("raw", "clean"), [
    ("  a ", "a"), ("   ", None), ("", None), (None, None), ("\ta\t", "\ta\t")])
def test_clean_text_strips_spaces_only(spark, raw, clean):
    assert values(one(spark, raw), text.clean_text(F.col("x"))) == [clean]


@pytest.mark.parametrize(("raw", "number"), [
    ("1 234,5", "1234.50"), ("1.005", "1.01"), ("-2,345", "-2.35"), (None, None)])
def test_parse_decimal(spark, raw, number):
    got = values(one(spark, raw), text.parse_decimal(F.col("x"), MONEY))
    assert got == [None if number is None else Decimal(number)]


def test_bad_text_fails_or_is_set_aside(spark):
    bad = [dict(fx.BOOKINGS[0], amount="abc"), dict(fx.BOOKINGS[1], transaction_date="02.08.2026"),
           fx.BOOKINGS[2]]
    raw = fx.raw(spark, bad)
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="not a (number|timestamp)"):
                typed_transactions(raw).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
    good, aside = quarantine(raw)
    assert values(good, "source_number") == ["3"]
    assert {r.source_number: r.bad_columns for r in aside.collect()} == {
        "1": ["amount"], "2": ["transaction_date"]}


def test_rates_of_unknown_source_and_zero_nominal(spark):
    raw = fx.raw_rates(spark, [("01.08.2026", "usd ", "0", "90,5"), ("2.8.26", "KGS", "1", "1")])
    raw = raw.withColumn("source", F.when(F.col("raw_id") == 2, "other").otherwise("cbr"))
    rows = stg_rates(raw).orderBy("raw_id").collect()
    assert rows[0].rate is None and rows[0].base_currency == "USD"
    assert rows[1].rate_date is None and rows[1].rate == 1


def test_only_the_newest_loaded_batch_counts(spark):
    raw = fx.raw(spark, fx.BOOKINGS[:2], 1).union(fx.raw(spark, fx.BOOKINGS[2:3], 2)) \
        .union(fx.raw(spark, fx.BOOKINGS[3:], 3))
    entries = fx.registry(spark, (1, "loaded"), (2, "loaded"), (3, "failed"))
    assert values(stg_transactions(raw, entries, *fx.SOURCE), "source_number") == ["3"]
    none = fx.registry(spark, (1, "processing"))
    assert stg_transactions(raw, none, *fx.SOURCE).isEmpty()


def test_transfer_legs(spark):
    base = fx.BOOKINGS[3]
    rows = [
        dict(base, source_number="both"),
        dict(base, source_number="account only", transfer_amount=None),
        dict(base, source_number="amount only", transfer_account=" "),
        dict(base, source_number="no currency", transfer_currency=""),
        dict(base, source_number="income", amount="7", transfer_amount="-5"),
    ]
    staged = stg_transactions(fx.raw(spark, rows), fx.registry(spark), *fx.SOURCE)
    got = core_transactions(staged, fx.accounts(spark), fx.as_of()).filter("source_number IS NOT NULL")
    legs = Counter((r.source_number, r.transaction_type) for r in got.collect())
    assert all(legs[(r["source_number"], "transfer_out")] == 1 for r in rows)
    assert {n for n, kind in legs if kind == "transfer_in"} == {"both", "no currency", "income"}
    mirror = {r.source_number: r for r in got.filter("transaction_type = 'transfer_in'").collect()}
    assert mirror["no currency"].currency == "RUB"
    assert mirror["income"].amount_abs == Decimal("-5.00")


def test_duplicate_source_rows_share_their_id(spark):
    staged = stg_transactions(fx.raw(spark, [fx.BOOKINGS[0]] * 2), fx.registry(spark), *fx.SOURCE)
    core = core_transactions(staged, fx.accounts(spark), fx.as_of())
    assert checks.unique(core, "transaction_id").count() == 1


TAGGED = [("recurring",), ("a, recurring",), ("a,recurring",), ("recurring, reserve",), (None,),
          ("",), ("recurring, recurring",)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_tag_matches(spark, limit):
    rows = spark.createDataFrame(TAGGED, "tags string")
    many = fx.tags(spark, ("recurring", True), ("reserve", True), ("recurring", True),
                   ("a", False), ("b", None), (None, True))
    joined = tags.tag_membership_join(rows, many, "hit", max_inline_tags=limit)
    assert Counter(map(tuple, joined.collect())) == {
        ("recurring", True): 2, ("a, recurring", True): 2, ("a,recurring", False): 1,
        ("recurring, reserve", True): 3, (None, False): 1, ("", False): 1,
        ("recurring, recurring", True): 2,
    }
    flags = tags.tag_flags(rows, many, "hit", max_inline_tags=limit)
    assert Counter(map(tuple, flags.collect())) == {
        (t[0], bool(t[0]) and t[0] != "a,recurring"): 1 for t in TAGGED}


def test_salted_lookup_agrees_with_broadcast(spark):
    # A third of all rows has one key; some keys have no partner.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = joins.lookup_join(left, right, ["k"], how, small=True)
        large = joins.lookup_join(left, right, ["k"], how, small=False)
        assert Counter(small.collect()) == Counter(large.select(*small.columns).collect())
    plan = joins.salted(left, right, 8)[0]
    assert plan.filter("k = 0").select("_salt").distinct().count() == 8


def test_targets_and_conversion_beyond_the_limits_agree(spark):
    rates = core_rates(stg_rates(fx.raw_rates(spark))).cache()
    rows = spark.createDataFrame(
        [(n, c, Decimal(n + 1), date(2026, 7, 30) + timedelta(n % 40) if n % 7 else None)
         for n, c in enumerate(["USD", "RUB", "KGS", "EUR", None] * 20)],
        "n long, currency string, amount decimal(18,2), day date")
    targets = rows.select(F.col("currency").alias("target_currency")).distinct()
    assert Counter(cross_targets(rows, targets).collect()) == Counter(
        cross_targets(rows, targets, 0).select(*rows.columns, "target_currency").collect())
    ways = [
        convert_to_targets(rows, rates, targets, "amount", F.col("day"), "out", **options)
        for options in ({}, {"max_board_entries": 0}, {"max_inline_targets": 0})
    ]
    first, *others = [Counter(w.collect()) for w in ways]
    assert sum(first.values()) == 500
    assert all(first == other for other in others)


def _brute_asof(left, right):
    out = Counter()
    for k, at in left:
        found = [(t, v) for rk, t, v in right if rk == k and k is not None and at is not None and t <= at]
        out[(k, at, max(found)[1] if found else None)] += 1
    return out


@pytest.mark.parametrize("strategy", ["auto", "interval", "dense", "union"])
def test_asof_by_date(spark, strategy):
    start = date(2020, 12, 20)
    left = [(k, start + timedelta(n * 3 % 70)) for n in range(60) for k in ("a", "b", None)]
    left += [("a", None), ("zzz", start)]
    right = [("a", start + timedelta(n * 5), n if n % 4 else None) for n in range(1, 9)]
    right += [("b", start + timedelta(60), 7), (None, start, 1)]
    ldf = spark.createDataFrame(left, "k string, at date")
    rdf = spark.createDataFrame(right, "k string, t date, v long")
    got = asof.asof_join(ldf, rdf, ["k"], "at", "t", ["v"], strategy, bucket_days=30)
    assert Counter(map(tuple, got.collect())) == _brute_asof(left, right)


@pytest.mark.parametrize("strategy", ["auto", "interval", "union"])
def test_asof_by_timestamp(spark, strategy):
    start = datetime(2020, 12, 30, 5)
    left = [("a" if n % 3 else "b", start + timedelta(minutes=n * 47)) for n in range(200)]
    right = [("a", start + timedelta(minutes=n * 101), n) for n in range(1, 80)]
    got = asof.asof_join(
        spark.createDataFrame(left, "k string, at timestamp"),
        spark.createDataFrame(right, "k string, t timestamp, v long"),
        ["k"], "at", "t", ["v"], strategy, bucket_days=2)
    assert Counter(map(tuple, got.collect())) == _brute_asof(left, right)


def test_asof_refuses_what_a_strategy_cannot_do(spark):
    rows = spark.createDataFrame([("a", datetime(2020, 1, 1), 1)], "k string, t timestamp, v long")
    left = rows.select("k", F.col("t").alias("at"))
    with pytest.raises(ValueError, match="kept by date"):
        asof.asof_join(left, rows, ["k"], "at", "t", ["v"], "dense")
    with pytest.raises(ValueError, match="strategy must be one of"):
        asof.asof_join(left, rows, ["k"], "at", "t", ["v"], "other")


def test_intervals_beyond_the_broadcast_limit_agree(spark):
    rows = spark.createDataFrame(
        [(k, datetime(2020, m, 1), m) for k in "ab" for m in (1, 2, 6)] + [(None, datetime(2020, 1, 1), 9)],
        "k string, t timestamp, v long")
    left = spark.createDataFrame(
        [(k, datetime(2020, m, d)) for k in ("a", "b", "c", None) for m in (1, 2, 5, 12) for d in (1, 15)]
        + [("a", None), ("a", datetime(2019, 1, 1))], "k string, at timestamp")
    few, many = (asof.asof_join(left, rows, ["k"], "at", "t", ["v"], "interval", max_broadcast_rows=limit)
                 for limit in (200_000, 0))
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_salted_copies_are_never_broadcast(spark):
    """Their number is not in the optimizer's estimate, so a join of copies is always shuffled."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rows = spark.createDataFrame([("a", date(2020, 1, 1), 1)], "k string, t date, v long")
    left = rows.select("k", F.col("t").alias("at"))
    spans = asof.asof_join(left, rows, ["k"], "at", "t", ["v"], "interval", max_broadcast_rows=0)
    targets = cross_targets(left, spark.createDataFrame([("USD",)], "target_currency string"), 0)
    looked_up = joins.lookup_join(left, rows, ["k"], small=False)
    for df in (spans, targets, looked_up):
        assert "SortMergeJoin" in plan(df) and "BroadcastHashJoin" not in plan(df)


def test_lookups_of_small_tables_start_no_job(spark, tmp_path):
    spark.range(50).selectExpr("id", "cast(id AS string) AS name").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    rows = spark.range(1000).withColumn("id", F.col("id") % 60)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    joined = joins.lookup_join(rows, dim, ["id"])
    missing = checks.active_tags_exist(
        spark.createDataFrame([("x", True)], "tag string, is_active boolean"),
        spark.createDataFrame([("x, y",)], "tags string"))
    assert len(tracker.getJobIdsForGroup("building")) == 0
    assert joined.count() == 1000 and missing.count() == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


LEDGER = ("account string, transaction_ts timestamp, amount decimal(18,2), currency string, "
          "transaction_type string, is_reserve_account boolean, is_credit_account boolean")


def _bookings(spark, rows):
    return spark.createDataFrame(
        [(a, datetime.fromisoformat(t) if t else None, Decimal(x), c, kind, False, False)
         for a, t, x, c, kind in rows], LEDGER)


def test_balances_at_the_edges(spark):
    rows = _bookings(spark, [
        ("a", "2026-08-28 10:00", "10", "USD", "opening_balance"),
        ("a", "2026-08-30 10:00", "-4", "EUR", "expense"),
        ("a", "2026-08-30 11:00", "-1", "USD", "expense"),
        ("a", "2026-09-05 00:00", "99", "USD", "income"),
        ("late", "2026-09-01 00:00", "5", "USD", "opening_balance"),
        (None, "2026-08-30 00:00", "7", "USD", "opening_balance"),
        ("a", None, "1000", "USD", "income"),
    ])
    days = balances.daily_balances(rows, fx.as_of()).collect()
    assert {(r.account, str(r.period_end)): int(r.balance) for r in days} == {
        ("a", "2026-08-28"): 10, ("a", "2026-08-29"): 10, ("a", "2026-08-30"): 5,
        ("a", "2026-08-31"): 5,
        # Nothing can be matched to a missing account, so its balance stays zero.
        (None, "2026-08-30"): 0, (None, "2026-08-31"): 0,
    }
    assert {r.currency for r in days} == {"USD"}


def test_balance_ways_agree(spark):
    rows = _bookings(spark, [
        (a, f"202{n % 5}-{n % 12 + 1:02d}-{n % 28 + 1:02d} 0{n % 9}:00", str(n - 40), "USD", "income")
        for n in range(120) for a in ("a", "b")])
    rows = rows.withColumn("amount", F.col("amount") + (F.col("account") == "b").cast("int"))
    end = F.lit("2025-02-11").cast("date")
    daily = balances.daily_balances(rows, end).cache()
    spine = balances.account_day_spine(balances.account_bounds(rows), end)
    plain = balances.running_balance(
        balances.spine_left_totals(spine, balances.daily_totals(rows)))
    pick = ["account", "day", "balance"]
    assert Counter(daily.withColumnRenamed("period_end", "day").select(*pick).collect()) == Counter(
        plain.withColumnRenamed("snapshot_date", "day").select(*pick).collect())
    ends = periods.period_ends(daily, "period_end", end)
    grouped = periods.period_end_snapshot(
        daily.withColumnRenamed("period_end", "d"), ["account"], "d", ["balance"])
    pick = ["account", "period_grain", "period", "period_end", "balance"]
    assert Counter(ends.select(*pick).collect()) == Counter(grouped.select(*pick).collect())


def test_long_spines_are_dealt_into_more_tasks(spark, monkeypatch):
    rows = _bookings(spark, [(f"a{n}", "2024-01-01 01:00", str(n), "USD", "income") for n in range(40)])
    spine = balances.account_day_spine(balances.account_bounds(rows), F.lit("2024-01-31").cast("date"))
    monkeypatch.setattr(balances, "ROWS_PER_TASK", 100)
    days = balances.running_balance(balances.spine_left_totals(spine, balances.daily_totals(rows)))
    assert days.rdd.getNumPartitions() == 13  # 40 accounts of 31 days
    assert Counter((r.account, int(r.balance)) for r in days.collect()) == {(f"a{n}", n): 31 for n in range(40)}


def test_calendar_spine_without_days(spark):
    rows = spark.createDataFrame([(date(2026, 9, 1),), (date(2026, 8, 30),)], "start date")
    assert values(periods.calendar_spine(rows, "start", fx.as_of(), "day"), F.col("day").cast("string")) \
        == ["2026-08-30", "2026-08-31"]


def test_future_bookings_are_in_the_facts(spark):
    future = [dict(fx.BOOKINGS[0], transaction_date="2027-01-05 00:00:00")]
    staged = stg_transactions(fx.raw(spark, future), fx.registry(spark), *fx.SOURCE)
    core = core_transactions(staged, fx.accounts(spark), fx.as_of()).cache()
    rates = core_rates(stg_rates(fx.raw_rates(spark)))
    none = fx.tags(spark, ("x", False))
    facts = marts.fact_mart(core, rates, none, none).filter("period = '2027' AND target_currency = 'RUB'")
    assert values(facts, "amount_abs_converted") == [Decimal("92000")]
    ends = marts.balance_mart(core, rates, fx.as_of()).filter("account = 'Wallet' AND period = '2026' AND target_currency = 'USD'")
    assert values(ends, "balance") == [Decimal("100.00")]


def test_negative_opening_keeps_its_sign_only_unmasked(spark):
    names = fx.accounts(spark, [(1, "Wallet", date(2020, 1, 1), Decimal(-9), "RUB", True, False, False)])
    staged = stg_transactions(fx.raw(spark, fx.BOOKINGS[:1]), fx.registry(spark, (9, "loaded")), *fx.SOURCE)
    core = core_transactions(staged, names, fx.as_of()).cache()
    rates = core_rates(stg_rates(fx.raw_rates(spark)))
    none = fx.tags(spark, ("x", False))
    masks = spark.createDataFrame([], "real_parent_category string, real_category string, "
                                  "demo_parent_category string, demo_category string, "
                                  "amount_factor decimal(18,6)")
    pick = "period_grain = 'Day' AND target_currency = 'RUB'"
    plain = marts.fact_mart(core, rates, none, none).filter(pick)
    masked = marts.fact_mart_masked(core, rates, none, none, names, names, masks).filter(pick)
    assert values(plain, "amount_abs_converted") == [Decimal(-9)]
    assert values(masked, "amount_abs_converted") == [Decimal(9)]


def _loads(spark, counts, system="s", start=datetime(2026, 8, 1)):
    rows = [(n, system, "o", "t", "b", f"k{n}", 1, None, "loaded", c, None, start, start,
             start + timedelta(days=n)) for n, c in enumerate(counts, 1)]
    return spark.createDataFrame(rows, FILE_REGISTRY)


@pytest.mark.parametrize(("counts", "status"), [
    ([5], "no_baseline"), ([5, 5], "weak_baseline"), ([5, 5, 5], "weak_baseline"),
    ([0, 0, 0, 5], "invalid_baseline"), ([10, 10, 10, 2], "anomaly"), ([10, 10, 10, 3], "warning"),
    ([10, 10, 10, 6], "warning"), ([10, 10, 10, 7], "normal"), ([10, 10, 10, 24], "normal"),
    ([10, 10, 10, 25], "warning"), ([999] + [10] * 8, "normal"), ([999, 10, 10] + [10] * 5, "anomaly"),
])
def test_volume_rules(spark, counts, status):
    result = monitoring.volume_monitoring(_loads(spark, counts), fx.as_of()).first()
    assert result.volume_status == status
    if status == "no_baseline":
        assert result.deviation_pct is None


@pytest.mark.parametrize(("age", "status", "words"), [
    (0, "fresh", "0 d 0 h 0 min"), (259200, "fresh", "3 d 0 h 0 min"),
    (259201, "warning", "3 d 0 h 0 min"), (604801, "stale", "7 d 0 h 0 min"),
    (93784, "fresh", "1 d 2 h 3 min")])
def test_freshness(spark, age, status, words):
    loads_ = _loads(spark, [1])
    now = datetime(2026, 8, 2) + timedelta(seconds=age)
    row = monitoring.freshness(loads_, F.lit(now)).first()
    assert (row.freshness_status, row.time_since_last_load_text) == (status, words)


def test_freshness_of_nothing_and_of_an_unfinished_load(spark):
    empty = monitoring.freshness(_loads(spark, [1]).filter("false"), fx.as_of()).collect()
    assert [r.freshness_status for r in empty] == ["no_data"] and empty[0].ingestion_id is None
    open_end = _loads(spark, [1, 2]).withColumn(
        "finished_at", F.when(F.col("ingestion_id") == 2, F.col("finished_at")))
    assert monitoring.freshness(open_end, fx.as_of()).first().ingestion_id == 1
    assert loads.last_successful_load(open_end).first().ingestion_id == 1


def test_age_rounds(spark):
    row = one(spark, datetime(2026, 1, 1, 0, 0, 0, 400000), "timestamp")
    now = F.lit(datetime(2026, 1, 1, 0, 0, 2))
    assert values(row, labels.age_seconds(now, F.col("x"))) == [2]


def test_checks_on_nulls(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "a"), (None, None), (1, "b"), (-1, "c")],
                                 "n long, s string")
    assert checks.not_null(rows, "n").count() == 2
    assert [tuple(r) for r in checks.unique(rows, "n").collect()] == [(1, 2)]
    assert checks.unique_combination(rows.select("n"), ["n"]).count() == 2
    assert values(checks.accepted_values(rows, "s", ["a", "b"]), "s") == ["c"]
    assert values(checks.positive(rows, "n"), "n") == [-1]
    parent = spark.createDataFrame([("a",)], "p string")
    assert sorted(values(checks.relationships(rows, "s", parent, "p"), "s")) == ["b", "c"]
    assert values(checks.relationships(rows, "s", parent, "p", "n > 0"), "s") == ["b"]


def test_suite_counts_rows_in_one_pass_and_enforces(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "x")], "n long, s string")
    run = suite.Suite().not_null("core_t", rows, "n", "s").accepted("dm_t", rows, "s", ["a"])
    results = run.run()
    assert {(r.test_name, r.failures, r.status) for r in results.collect()} == {
        ("not_null_n", 1, "fail"), ("not_null_s", 0, "pass"), ("accepted_values_s", 1, "warn")}
    with pytest.raises(ValueError, match=r"core_t\.not_null_n: 1"):
        suite.enforce(results)
    logged = suite.log_results(results, "prod", "run-1", F.lit(datetime(2026, 1, 1)))
    assert checks.unique_combination(logged, ["target_name", "invocation_id", "unique_id"]).isEmpty()


def test_conversion_needs_both_rates(spark):
    row = spark.range(1)
    lit = SimpleNamespace(n=F.lit(None).cast("decimal(24,12)"), z=F.lit(0).cast("decimal(24,12)"),
                          r=F.lit(2).cast("decimal(24,12)"), a=F.lit(10).cast("decimal(18,2)"))
    def convert(a, b, own, target):
        out = amounts.convert_amount(lit.a, F.lit(a), F.lit(b), own, target)
        return row.select(out).first()[0]
    assert convert("USD", "USD", lit.n, lit.n) == 10
    assert convert("RUB", "USD", lit.n, lit.r) == 5
    assert convert("USD", "RUB", lit.r, lit.n) == 20
    assert convert("USD", "KGS", lit.r, lit.r) == 10
    assert convert("RUB", "USD", lit.n, lit.z) is None
    assert convert("USD", "KGS", lit.r, lit.n) is None
    assert convert("USD", "KGS", lit.n, lit.r) is None


def test_conversion_is_exact(spark):
    """Quotients by hand, rounded once to six decimals."""
    rows = [("1234.57", "USD", "KGS", "90.1234", "1.0353"), ("1234.56", "USD", "KGS", "0.003712345678", "0.000021234567"),
            ("-0.01", "USD", "KGS", "90.1234", "1.0353"), ("1234.57", "RUB", "KGS", None, "0.000021234567"),
            ("9999999999999999.99", "USD", "RUB", "1.000000000001", None), ("5.00", "USD", "KGS", "1", "0"),
            ("5.00", "USD", "KGS", None, "1"), ("7.77", "USD", "USD", None, None)]

    def want(amount, own, target, own_rate, target_rate):
        value = Decimal(amount)
        if own != target:
            rates = [Decimal(1) if c == "RUB" else None if r is None else Decimal(r)
                     for c, r in ((own, own_rate), (target, target_rate))]
            if None in rates or rates[1] == 0:
                return None
            with localcontext() as exact:
                exact.prec = 80
                value = value * rates[0] / rates[1]
        with localcontext() as exact:
            exact.prec = 80
            return value.quantize(Decimal("0.000001"), ROUND_HALF_UP)

    for kind in ("decimal(18,2)", "decimal(38,2)"):
        df = spark.createDataFrame(
            [(i, *(None if v is None else Decimal(v) if "." in v or v.isdigit() else v for v in r))
             for i, r in enumerate(rows)],
            "i int, amount decimal(38,2), own string, target string, a decimal(24,12), b decimal(24,12)")
        out = df.select("i", amounts.convert_amount(F.col("amount").cast(kind), F.col("own"), F.col("target"),
                                                    F.col("a"), F.col("b")).alias("c"))
        assert {r.i: r.c for r in out.collect()} == {i: want(*r) for i, r in enumerate(rows)}
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        spark.sql("SELECT CAST('12345678901234567.00' AS DECIMAL(38,2)) AS a").select(
            amounts.convert_amount(F.col("a"), F.lit("USD"), F.lit("USD"), F.lit(None), F.lit(None))).collect()


def test_conversion_to_targets_rounds_ties_and_large_amounts_exactly(spark):
    """Quotients next to and on half a millionth, and beyond what a binary number holds."""
    rates = spark.createDataFrame(
        [(1, "USD", date(2026, 1, 1), Decimal("1")), (2, "KGS", date(2026, 1, 1), Decimal("8")),
         (3, "EUR", date(2026, 1, 1), Decimal("0.3")), (4, "NIL", date(2026, 1, 1), Decimal("0"))],
        "raw_id long, base_currency string, rate_date date, rate decimal(24,12)")
    many = spark.createDataFrame([("BIG", date(2026, 1, 1), Decimal("80000")), ("ODD", date(2026, 1, 1), Decimal("79999.999999999"))],
                                 "base_currency string, rate_date date, rate decimal(24,12)").withColumn("raw_id", F.lit(9))
    rates = rates.unionByName(many)
    amount = ["0.01", "0.04", "-0.04", "0.12", "-0.12", "1234567.89", "9999999999999999.99", "-9999999999999999.97", "0.00"]
    rows = spark.createDataFrame([(Decimal(a), c, d) for a in amount for c in ("USD", "RUB", "XXX", None)
                                  for d in (date(2026, 2, 1), date(2025, 1, 1))],
                                 "amount decimal(18,2), currency string, day date")
    codes = ["USD", "KGS", "EUR", "NIL", "BIG", "ODD", "RUB", "XXX"]
    targets = spark.createDataFrame([(c,) for c in codes], "target_currency string")
    got = convert_to_targets(rows, rates, targets, "amount", F.col("day"), "out").collect()
    known = {r.base_currency: r.rate for r in rates.collect()}

    def want(r):
        if r.currency == r.target_currency:
            return r.amount
        own, to = (Decimal(1) if c == "RUB" else known.get(c) if r.day.year == 2026 else None
                   for c in (r.currency, r.target_currency))
        if own is None or not to:
            return None
        with localcontext() as exact:
            exact.prec = 80
            return (r.amount * own / to).quantize(Decimal("0.000001"), ROUND_HALF_UP)

    assert len(got) == rows.count() * len(codes)
    assert [(r, want(r)) for r in got if r.out != want(r)] == []


def test_marts_convert_before_periods_multiply(spark):
    """One conversion per row and target, with its rate beside the target instead of a search per target."""
    core = core_transactions(stg_transactions(fx.raw(spark), fx.registry(spark), *fx.SOURCE), fx.accounts(spark), fx.as_of())
    rates = core_rates(stg_rates(fx.raw_rates(spark)))
    none = spark.createDataFrame([], "tag string, is_active boolean")
    for mart in (marts.fact_mart(core, rates, none, none), marts.balance_mart(core, rates, fx.as_of())):
        plan = mart._jdf.queryExecution().optimizedPlan().toString()
        assert -1 < plan.find("Generate inline(_periods") < plan.find("Generate inline(_targets")
        assert "map" not in plan.split("Generate inline(_targets")[0]


def test_rows_of_a_run_are_not_all_held_at_once(spark):
    """Days are made in another compiled stage than their rows per target and period."""
    core = core_transactions(stg_transactions(fx.raw(spark), fx.registry(spark), *fx.SOURCE), fx.accounts(spark), fx.as_of())
    mart = marts.balance_mart(core, core_rates(stg_rates(fx.raw_rates(spark))), fx.as_of())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = mart.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stage = {what: re.search(r"\*\((\d+)\) Generate " + what, plan)[1]
             for what in (r"inline\(_targets", r"inline\(_periods", r"explode\(sequence\(valid_from")}
    assert stage[r"inline\(_targets"] == stage[r"inline\(_periods"] != stage[r"explode\(sequence\(valid_from"]


def test_a_sure_quotient_needs_no_decimal_product(spark):
    rates = spark.createDataFrame([(1, "USD", date(2026, 1, 1), Decimal("3"))],
                                  "raw_id long, base_currency string, rate_date date, rate decimal(24,12)")
    rows = spark.createDataFrame([(Decimal("250000000.01"), "RUB", date(2026, 2, 1)), (Decimal("-0.02"), "RUB", date(2026, 2, 1))],
                                 "amount decimal(18,2), currency string, day date")
    targets = spark.createDataFrame([("USD",)], "target_currency string")
    got = convert_to_targets(rows, rates, targets, "amount", F.col("day"), "out")
    assert "* 0.000001" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.out for r in got.collect()) == [Decimal("-0.006667"), Decimal("83333333.336667")]

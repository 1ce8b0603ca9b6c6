"""Files, registry, rates and the build, end to end on small files."""

import csv
import os
import random
from datetime import date, datetime
from decimal import Decimal

import fixture as fx
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import monitoring
from ledgerloom.plans.pipeline import (
    Reference, build_layers, load_exchange_rates, load_latest_export, log_checks, run_all,
)
from ledgerloom.schemas import (
    DIM_ACCOUNTS, EXPORT_COLUMNS, FILE_REGISTRY, RATE_STATE, TAG_DICTIONARY,
)
from ledgerloom.sources import exports, partitions, rates, records, registry, sinks
from ledgerloom.streaming import ingest
from ledgerloom.streaming.ingest import stream_ingest, stream_upsert_rates


def write_export(path, bookings, headers=None):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow([*(headers or EXPORT_COLUMNS), "Balance"])
        for b in bookings:
            writer.writerow([*(b.get(raw, "") for raw in EXPORT_COLUMNS.values()), "0"])


def now(text="2026-08-31 00:00:00"):
    return F.lit(text).cast("timestamp")


ODD_NOTE = dict(fx.BOOKINGS[0], note='says "hi", then\nleaves')


def test_export_keeps_text_and_drops_other_columns(spark, tmp_path):
    write_export(tmp_path / "a.csv", [ODD_NOTE, dict(fx.BOOKINGS[1], account="  padded ")])
    rows = exports.read_ledger_export(spark, str(tmp_path)).collect()
    assert {r.note for r in rows} == {ODD_NOTE["note"], ""}
    assert {r.account for r in rows} == {"Wallet", "  padded "}
    assert "Balance" not in rows[0].asDict() and rows[0].source_file.endswith("a.csv")


def test_broken_exports(spark, tmp_path):
    headers = [h for h in EXPORT_COLUMNS if h not in ("Tags", "Note")]
    write_export(tmp_path / "a.csv", [{}], headers)
    with pytest.raises(ValueError, match="lacks columns: Note, Tags"):
        exports.read_ledger_export(spark, str(tmp_path / "a.csv"))
    write_export(tmp_path / "b.csv", [])
    with pytest.raises(ValueError, match="no data rows"):
        exports.read_ledger_export(spark, str(tmp_path / "b.csv"))


def test_sizes_and_checksums(spark, tmp_path):
    for name, body in (("a", "x\n" * 10), ("b", "y\n" * 500), ("c", "y\n" * 500)):
        (tmp_path / name).write_text(body)
    got = {r.path[-1]: r for r in exports.file_metadata(spark, str(tmp_path)).collect()}
    assert {k: r.file_size_bytes for k, r in got.items()} == {"a": 20, "b": 1000, "c": 1000}
    assert got["b"].file_checksum == got["c"].file_checksum != got["a"].file_checksum


def test_seed_with_spaces(spark, tmp_path):
    (tmp_path / "tags.csv").write_text("tag,is_active\nregular, true\nold, false\n")
    got = exports.read_seed(spark, str(tmp_path), TAG_DICTIONARY)
    assert {tuple(r) for r in got.collect()} == {("regular", True), ("old", False)}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("tag,is_active\nregular,maybe\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        exports.read_seed(spark, str(tmp_path / "bad"), TAG_DICTIONARY).collect()


def test_newest_export_is_loaded_once(spark, tmp_path):
    inbox, raw, entries = (str(tmp_path / n) for n in ("in", "raw", "registry"))
    (tmp_path / "in").mkdir()
    write_export(tmp_path / "in" / "a.csv", fx.BOOKINGS)
    load = lambda: load_latest_export(spark, inbox, raw, entries, fx.SOURCE, now())
    assert load() == "loaded" and load() == "skipped"
    write_export(tmp_path / "in" / "b.csv", [{}], ["Number"])
    with pytest.raises(ValueError, match="lacks columns"):
        load()
    log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
    got = {r.ingestion_id: r for r in log.collect()}
    assert {i: r.status for i, r in got.items()} == {1: "loaded", 2: "failed"}
    assert got[1].rows_loaded == 5 and got[1].started_at and got[1].finished_at
    assert "lacks columns" in got[2].error_message and got[1].error_message is None
    # The file is repaired under the same name and tried again under the same id.
    write_export(tmp_path / "in" / "b.csv", fx.BOOKINGS[:2])
    assert load() == "loaded"
    log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
    assert {r.ingestion_id: (r.status, r.rows_loaded, r.error_message) for r in log.collect()} == {
        1: ("loaded", 5, None), 2: ("loaded", 2, None)}
    assert spark.read.parquet(raw).groupBy("ingestion_id").count().count() == 2


def test_long_errors_are_cut(spark):
    event = spark.createDataFrame(
        [(1, "failed", datetime(2026, 1, 1), None, "x" * 5000)],
        "ingestion_id long, status string, event_ts timestamp, rows_loaded int, error_message string")
    entry = spark.createDataFrame([(1, *[None] * 13)], FILE_REGISTRY)
    assert len(registry.registry_transition(entry, event).first().error_message) == 4000


def _rate_files(folder, currency, records):
    target = folder / f"currency={currency}"
    target.mkdir(parents=True, exist_ok=True)
    body = "".join(f'<Record Date="{d}"><Nominal>{n}</Nominal><Value>{v}</Value></Record>'
                   for d, n, v in records)
    (target / f"{len(list(target.iterdir()))}.xml").write_text(f"<ValCurs>{body}</ValCurs>")


def test_rates_are_merged_when_due(spark, tmp_path):
    catalog = tmp_path / "catalog.xml"
    catalog.write_text('<ValCurs><Valute ID="R1"><CharCode>usd</CharCode></Valute>'
                       '<Valute ID="R2"><CharCode>KGS</CharCode></Valute>'
                       '<Valute ID=""><CharCode>EUR</CharCode></Valute></ValCurs>')
    documents = tmp_path / "documents"
    _rate_files(documents, "USD", [("01.08.2026", "1", "90,5"), ("02.08.2026", "1", "90,6"),
                                   ("03.08.2026", "", "1"), ("01.01.2020", "1", "60")])
    _rate_files(documents, "KGS", [("01.08.2026", "10", "10,3")])
    dates = spark.createDataFrame([(date(2026, 8, 1),)], "transaction_date date")
    table, state = str(tmp_path / "table"), str(tmp_path / "state")

    def load(at, *codes):
        wanted = spark.createDataFrame([("cbr", c) for c in codes], "source string, currency_code string")
        return load_exchange_rates(spark, str(documents), str(catalog), table, state, wanted, dates, now(at))

    with pytest.raises(ValueError, match="not in the catalog: EUR"):
        load("2026-08-02 12:00:00", "EUR")
    assert load("2026-08-02 12:00:00", "RUB") == "skipped"
    assert load("2026-08-02 12:00:00", "USD", "KGS", "RUB") == "loaded"
    rows, _ = rates.read_rate_table(spark, table)
    assert {(r.base_currency, r.rate_date, r.quote_amount) for r in rows.collect()} == {
        ("USD", "01.08.2026", "90,5"), ("USD", "02.08.2026", "90,6"), ("KGS", "01.08.2026", "10,3")}
    assert load("2026-08-02 17:59:00", "USD", "KGS") == "skipped"
    assert load("2026-08-02 18:00:00", "USD", "KGS") == "skipped"
    moved, _ = sinks.read_version(spark, state, RATE_STATE)
    assert {(r.currency_code, str(r.last_rate_date), r.last_rows_affected) for r in moved.collect()} == {
        ("USD", "2026-08-02", 0), ("KGS", "2026-08-01", 0)}
    first = {r.rate_date: r.ingested_at for r in rows.filter("base_currency = 'USD'").collect()}
    # A later document corrects one rate, downwards and in fewer letters, and adds one.
    _rate_files(documents, "USD", [("02.08.2026", "1", "9"), ("03.08.2026", "1", "92")])
    os.utime(documents / "currency=USD" / "1.xml", (2_000_000_000, 2_000_000_000))
    assert load("2026-08-03 12:00:00", "USD") == "loaded"
    rows, _ = rates.read_rate_table(spark, table)
    got = {r.rate_date: r for r in rows.filter("base_currency = 'USD'").collect()}
    assert {d: r.quote_amount for d, r in got.items()} == {
        "01.08.2026": "90,5", "02.08.2026": "9", "03.08.2026": "92"}
    assert got["01.08.2026"].ingested_at == first["01.08.2026"] < got["02.08.2026"].ingested_at
    moved, _ = sinks.read_version(spark, state, RATE_STATE)
    assert {r.currency_code: r.last_rows_affected for r in moved.collect()} == {"USD": 2, "KGS": 0}


def _files(folder):
    return {str(f): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_a_correction_touches_only_its_year(spark, tmp_path):
    inbox, table, state = tmp_path / "in", tmp_path / "table", str(tmp_path / "state")
    catalog = spark.createDataFrame([("USD", "R1"), ("KGS", "R2")], "currency_code string, currency_id string")

    def run(at):
        stream_upsert_rates(spark, str(inbox), str(table), state, catalog, now(at)).awaitTermination()
        rows, version = rates.read_rate_table(spark, str(table))
        return {(r.base_currency, r.rate_date): (r.quote_amount, str(r.ingested_at)[:10]) for r in rows.collect()}, version

    def files(year):
        return {f: t for f, t in _files(table / "rows").items() if f"rate_year={year}" in f}

    _rate_files(inbox, "USD", [("01.07.2025", "1", "80"), ("01.08.2026", "1", "90"), ("02.08.2026", "1", "91")])
    _rate_files(inbox, "KGS", [("01.07.2025", "10", "10"), ("31.13.2026", "1", "5")])
    got, version = run("2026-08-10 00:00:00")
    assert got[("USD", "01.08.2026")] == ("90", "2026-08-10") and len(got) == 5 and version == 1
    before_last, undated, last = files("2025"), files("undated"), files("2026")
    assert before_last and undated and last
    # Only 2026 is corrected, and 2025 comes again as it was; a document written earlier does not count.
    _rate_files(inbox, "USD", [("01.08.2026", "1", "9"), ("01.07.2025", "1", "80")])
    _rate_files(inbox, "USD", [("02.08.2026", "1", "1")])
    os.utime(inbox / "currency=USD" / "1.xml", (2_000_000_000, 2_000_000_000))
    os.utime(inbox / "currency=USD" / "2.xml", (1_000_000_000, 1_000_000_000))
    got, version = run("2026-08-11 00:00:00")
    assert got[("USD", "01.08.2026")] == ("9", "2026-08-11") and got[("USD", "02.08.2026")] == ("91", "2026-08-10")
    assert got[("USD", "01.07.2025")] == ("80", "2026-08-10") and len(got) == 5 and version == 2
    assert files("2025") == before_last and files("undated") == undated and len(files("2026")) > len(last)
    # An older document in a later start finds the newer one in the state.
    _rate_files(inbox, "USD", [("01.08.2026", "1", "3")])
    os.utime(inbox / "currency=USD" / "3.xml", (1_900_000_000, 1_900_000_000))
    before = _files(table / "rows")
    assert run("2026-08-12 00:00:00") == (got, 2) and _files(table / "rows") == before


def test_partitions_are_replaced_whole_and_again(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "n long, p string, q string"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    read = lambda **at: sorted(map(tuple, partitions.read_partitions(
        spark, path, frame().schema, ["p", "q"], **at)[0].collect()))
    assert read() == []
    partitions.write_partitions_as(frame((1, "a/b", "x"), (2, "c", "x y")), path, ["p", "q"], 1)
    for _ in range(2):  # a write that is repeated replaces itself
        partitions.write_partitions_as(frame((3, "c", "x y"), (4, "=", "%")), path, ["p", "q"], 2)
    assert read() == [(1, "a/b", "x"), (3, "c", "x y"), (4, "=", "%")]
    assert read(below=2) == [(1, "a/b", "x"), (2, "c", "x y")]
    partitions.write_partitions_as(frame(), path, ["p", "q"], 3, emptied=[("=", "%")])
    assert read() == [(1, "a/b", "x"), (3, "c", "x y")]
    # A write that never published its list is not seen, and folders out of use are removed.
    frame((9, "c", "z")).write.partitionBy("p", "q").parquet(f"{path}/rows/_written=4")
    assert read() == [(1, "a/b", "x"), (3, "c", "x y")]
    for version in range(5, 9):
        partitions.write_partitions_as(frame((version, "a/b", "x"), (version, "c", "x y")), path, ["p", "q"], version)
    assert read() == [(8, "a/b", "x"), (8, "c", "x y")]
    assert sorted(os.listdir(f"{path}/rows")) == [f"_written={v}" for v in (6, 7, 8)]
    plan = partitions.read_partitions(spark, path, frame().schema, ["p", "q"])[0] \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [concat_ws" in plan


def test_settings_are_checked(spark):
    wanted = spark.createDataFrame([("cbr", "USD")], "source string, currency_code string")
    state, dates = spark.createDataFrame([], RATE_STATE), spark.createDataFrame([(None,)], "transaction_date date")
    with pytest.raises(ValueError, match="at least one minute"):
        rates.refresh_due(wanted, state, now(), minutes=0)
    for days in ({"lookback_days": -1}, {"reload_days": -1}):
        with pytest.raises(ValueError, match="negative"):
            rates.request_window(wanted, dates, now().cast("date"), **days)
    with pytest.raises(ValueError, match="not 'done'"):
        run_all(lambda: "done", lambda: "loaded", dict)


def test_new_currency_without_rates_is_an_error(spark, tmp_path):
    (tmp_path / "catalog.xml").write_text(
        '<ValCurs><Valute ID="R1"><CharCode>USD</CharCode></Valute></ValCurs>')
    _rate_files(tmp_path / "d", "USD", [("01.01.2000", "1", "1")])
    wanted = spark.createDataFrame([("cbr", "USD")], "source string, currency_code string")
    dates = spark.createDataFrame([(None,)], "transaction_date date")
    with pytest.raises(ValueError, match="no rates for new currencies: USD"):
        load_exchange_rates(spark, str(tmp_path / "d"), str(tmp_path / "catalog.xml"),
                            str(tmp_path / "t"), str(tmp_path / "s"), wanted, dates, now())


@pytest.mark.parametrize("limit", [0, 100])
def test_upsert_changes_only_what_differs(spark, limit):
    schema = "k string, v string, touched string"
    old = spark.createDataFrame([("same", "1", "old"), ("none", None, "old"), ("other", "1", "old"),
                                 ("alone", "1", "old")], schema)
    new = spark.createDataFrame([("same", "1"), ("none", None), ("other", "2"), ("fresh", "3"),
                                 ("fresh", "4")], "k string, v string")
    merge = lambda base: rates.upsert_changed(
        base, new, ["v"], ["k"], ["v"], {"touched": F.lit("new")}, max_broadcast_rows=limit)
    once = merge(old)
    assert {tuple(r) for r in once.collect()} == {
        ("same", "1", "old", "none"), ("none", None, "old", "none"), ("other", "2", "new", "update"),
        ("alone", "1", "old", "none"), ("fresh", "4", "new", "insert")}
    again = merge(once.drop("change"))
    assert again.filter("change != 'none'").isEmpty() and again.count() == 5


def test_appending_again_changes_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    first = sinks.insert_ignore(rows.limit(0), rows, ["k"], ["v"])
    assert {tuple(r) for r in first.collect()} == {(1, "a"), (2, "c")}
    assert sinks.insert_ignore(first, rows, ["k"], ["v"]).isEmpty()


def test_stream_picks_up_each_file_once(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    raw, entries, state = (str(tmp_path / n) for n in ("raw", "registry", "state"))
    counts = []
    for name, rows in (("a", fx.BOOKINGS), ("b", [ODD_NOTE]), (None, None)):
        if name:
            write_export(inbox / f"{name}.csv", rows)
        stream_ingest(spark, str(inbox), raw, entries, state, fx.SOURCE, now()).awaitTermination()
        landed = spark.read.parquet(raw)
        log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
        counts.append((landed.count(), log.count(), log.select("ingestion_id").distinct().count()))
    assert counts == [(5, 1, 1), (6, 2, 2), (6, 2, 2)]
    assert ODD_NOTE["note"] in {r.note for r in landed.collect()}


def test_stream_marks_unfit_files_and_feeds_monitoring(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    raw, entries, state = (str(tmp_path / n) for n in ("raw", "registry", "state"))
    write_export(inbox / "good.csv", fx.BOOKINGS)
    write_export(inbox / "empty.csv", [])
    (inbox / "foreign.csv").write_text("Number,Other\n1,2\n")
    headers = list(EXPORT_COLUMNS)[::-1]
    with open(inbox / "turned.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([headers, [ODD_NOTE.get(EXPORT_COLUMNS[h], "") for h in headers]])
    for _ in range(2):
        stream_ingest(spark, str(inbox), raw, entries, state, fx.SOURCE, now()).awaitTermination()
    log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
    got = {os.path.basename(r.s3_key): r for r in log.collect()}
    assert {n: (r.status, r.rows_loaded) for n, r in got.items()} == {
        "good.csv": ("loaded", 5), "turned.csv": ("loaded", 1), "empty.csv": ("failed", None),
        "foreign.csv": ("failed", None)}
    assert got["empty.csv"].error_message == "export has no data rows"
    assert got["foreign.csv"].error_message.startswith("export lacks columns: Account, ")
    assert sorted(r.ingestion_id for r in got.values()) == [1, 2, 3, 4]
    assert all(r.file_checksum and r.started_at and r.discovered_at for r in got.values())
    landed = spark.read.parquet(raw)
    assert landed.count() == 6 and ODD_NOTE["note"] in {r.note for r in landed.collect()}
    assert monitoring.freshness(log, now()).first().freshness_status == "fresh"
    assert monitoring.volume_monitoring(log, now()).count() == 1


def test_checksums_see_order_and_bytes_and_not_splits(spark, tmp_path):
    texts = {"a": "x\ny\n" * 900, "b": "y\nx\n" * 900, "c": "x\r\ny\r\n" * 900, "d": "x\ny\n" * 899 + "x\ny",
             "f": "x\ny\n" * 900, "g": "x\n\ny\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())

    def sums():
        return {os.path.basename(r.path)[0]: r.file_checksum
                for r in exports.file_metadata(spark, str(tmp_path)).collect()}

    whole = sums()
    assert whole["a"] == whole["f"] and len(set(whole.values())) == len(texts) - 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
        assert sums() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_line_breaks_survive_any_split(spark, tmp_path):
    rows = []
    for n in range(120):
        booking = dict(ODD_NOTE, source_number=str(n))
        booking["note"] = ["plain", "two\nlines", 'a "quoted"\n\n"word"', "x,\r\ny", "", '"'][n % 6] + "é" * (n % 7)
        rows.append(booking)
    write_export(tmp_path / "a.csv", rows)
    write_export(tmp_path / "b.csv", rows[:3])
    columns = list(EXPORT_COLUMNS.values())
    want = sorted(tuple(b.get(c, "") for c in columns) for b in rows + rows[:3])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("97b", "1000b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = exports.read_ledger_export(spark, str(tmp_path), split=True).select(*columns).collect()
            assert sorted(map(tuple, got)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _value(rng, broken):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(["", "ab", 'é"', ' "a"', " ", '5" pipe', '5" pipe "x"', "a" * 30])
    if kind < 0.7:
        inner = (rng.choice(["a", "b", ",", "\n", '""', " ", "\r\n", "é"]) for _ in range(rng.randrange(9)))
        return '"' + "".join(inner) + '"'
    # Text behind a closing quote, where readers differ in the value but not in the record.
    return '"a"' + rng.choice([" ", "x", " x", ' "y"']) if broken else "plain"


@pytest.mark.parametrize("size", ["23b", "128m"])
@pytest.mark.parametrize("seed", range(4))
def test_split_reader_agrees_with_others(spark, tmp_path, size, seed):
    rng, broken = random.Random(seed), seed % 2 == 1
    end = "\r\n" if seed > 1 else "\n"
    body = "".join(",".join(_value(rng, broken) for _ in range(3)) + end for _ in range(rng.randrange(1, 60)))
    text = ("\ufeff" if seed == 0 else "") + "H1,H2,H3" + end + body
    (tmp_path / "a.csv").write_bytes((text.rstrip("\r\n") if seed % 3 else text).encode())
    path = str(tmp_path / "a.csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        headers = exports.export_headers(spark, path)
        assert headers == ["H1", "H2", "H3"]
        found = records.split_records(spark, path, headers)
        got = sorted(tuple(x or "" for x in r[1:]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    one_task = spark.read.options(**exports.export_options()).csv(path)
    # Where lines end with \r\n the reader of whole files also turns those inside quotes into \n.
    plain = lambda rows: sorted(tuple(x.replace("\r\n", "\n") for x in r) for r in rows)
    assert plain(got) == plain([tuple(x or "" for x in r) for r in one_task.collect()])
    if not broken:
        with open(path, newline="", encoding="utf-8-sig") as lines:
            rows = [tuple(r) for r in csv.reader(lines) if r][1:]
        assert got == sorted((*r, "", "")[:3] for r in rows)


def test_a_stray_quote_loses_no_rows(spark, tmp_path):
    rows = [dict(fx.BOOKINGS[0], source_number=str(n), place=p) for n, p in enumerate(['5" pipe', "2", "3", "4"])]
    lines = [",".join(EXPORT_COLUMNS)] + [",".join(b.get(c, "") for c in EXPORT_COLUMNS.values()) for b in rows]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    for split in (True, False):
        got = exports.read_ledger_export(spark, str(tmp_path), split=split).collect()
        assert sorted((r.source_number, r.place) for r in got) == [("0", '5" pipe'), ("1", "2"), ("2", "3"), ("3", "4")]


def test_states_run_through_lines():
    rng = np.random.default_rng(2)
    for start in (False, True):
        bare, quoted = rng.random(200) < 0.4, rng.random(200) < 0.6
        want = [start]
        for b, q in zip(bare, quoted):
            want.append(bool(q if want[-1] else b))
        assert records.walk(bare, quoted, start).tolist() == want


def test_files_that_need_a_whole_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"H1,H2\rx,1\ry,2\r")
    assert records.split_records(spark, str(tmp_path / "a.csv"), ["H1", "H2"]) is None
    assert exports.read_delimited(spark, str(tmp_path / "a.csv"), ["H1", "H2"]).count() == 2
    (tmp_path / "b.csv").write_text('H1,H2\n"x\ny",1\n"x\n\n\ny",2\n')
    assert records.split_records(spark, str(tmp_path / "b.csv"), ["H1", "H2"], delimiter="||") is None
    other = records.split_records(spark, str(tmp_path / "b.csv"), ["H1", "H3"])
    with pytest.raises(Exception, match="another header: H1,H2"):
        other.collect()


def test_stream_reads_other_delimiters_and_encodings(spark, tmp_path):
    for name, encoding in (("one", "UTF-8"), ("two", "UTF-16")):
        inbox = tmp_path / name / "in"
        inbox.mkdir(parents=True)
        with open(inbox / "a.csv", "w", newline="", encoding=encoding) as out:
            writer = csv.writer(out, delimiter=";", quotechar="'")
            writer.writerow(EXPORT_COLUMNS)
            writer.writerow([dict(ODD_NOTE, place="дом; 'сад'\n1").get(c, "") for c in EXPORT_COLUMNS.values()])
        raw, entries, state = (str(tmp_path / name / n) for n in ("raw", "registry", "state"))
        stream_ingest(spark, str(inbox), raw, entries, state, fx.SOURCE, now(), encoding=encoding,
                      delimiter=";", quote="'").awaitTermination()
        rows = spark.read.parquet(raw).collect()
        assert [(r.place, r.note) for r in rows] == [("дом; 'сад'\n1", ODD_NOTE["note"])]


def test_a_file_that_cannot_be_read_does_not_stop_the_stream(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for name in "abc":
        write_export(inbox / f"{name}.csv", fx.BOOKINGS)
    read = ingest.read_delimited

    def breaking(session, paths, *args, **options):
        if any(p.endswith("b.csv") for p in paths):
            raise OSError("block is lost")
        return read(session, paths, *args, **options)

    monkeypatch.setattr(ingest, "read_delimited", breaking)
    raw, entries, state = (str(tmp_path / n) for n in ("raw", "registry", "state"))
    stream_ingest(spark, str(inbox), raw, entries, state, fx.SOURCE, now()).awaitTermination()
    log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
    got = {os.path.basename(r.s3_key): (r.status, r.rows_loaded, r.error_message) for r in log.collect()}
    assert got == {"a.csv": ("loaded", 5, None), "b.csv": ("failed", None, "block is lost"), "c.csv": ("loaded", 5, None)}


def test_only_the_newest_versions_are_kept_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        sinks.write_version(spark.createDataFrame([(n,)], "n long"), path, n)
    assert sinks.versions(spark, path) == [3, 4, 5]
    table, version = sinks.read_version(spark, path, spark.createDataFrame([], "n long").schema)
    assert version == 5 and table.first().n == 5
    assert all("table_version=5" in f for f in table.inputFiles())
    (tmp_path / "t" / "table_version=6").mkdir()  # a writer that never finished
    assert sinks.read_version(spark, path, table.schema)[1] == 5


def test_failed_checks_are_on_record(spark, tmp_path):
    names = spark.createDataFrame(fx.accounts(spark).collect()[:3], DIM_ACCOUNTS)
    reference = Reference(names, fx.tags(spark, ("regular", True)), fx.tags(spark, ("from reserve", True)))
    with pytest.raises(ValueError, match="accounts_exist_in_dim_accounts: 1"):
        build_layers(fx.raw(spark), fx.registry(spark), fx.raw_rates(spark), reference, fx.SOURCE,
                     now(), str(tmp_path / "layers"), prefix="v_", target="dev", invocation="r1")
    for kind in ("history", "current"):
        failed = spark.read.parquet(str(tmp_path / "layers" / "checks" / kind)).filter("status = 'fail'").collect()
        assert [(r.unique_id, r.failures, r.message) for r in failed] == [
            ("core_fact_transaction.accounts_exist_in_dim_accounts", 1, "1 failing rows")]
        assert failed[0].execution_time_s > 0


def test_a_run_without_news_builds_nothing():
    calls = []

    def step(name, result):
        return lambda: calls.append(name) or result

    assert run_all(step("exports", "skipped"), step("rates", "skipped"), step("build", {})) is None
    assert run_all(step("exports", "skipped"), step("rates", "loaded"), step("build", {"t": 1})) == {"t": 1}
    assert calls == ["exports", "rates", "exports", "rates", "build"]


def test_build_from_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_export(tmp_path / "in" / "a.csv", fx.BOOKINGS)
    raw, entries = str(tmp_path / "raw"), str(tmp_path / "registry")
    load_latest_export(spark, str(tmp_path / "in"), raw, entries, fx.SOURCE, now())
    log, _ = sinks.read_version(spark, entries, FILE_REGISTRY)
    reference = Reference(fx.accounts(spark), fx.tags(spark, ("regular", True)),
                          fx.tags(spark, ("from reserve", True)))
    landed = spark.read.parquet(raw)
    layers = build_layers(landed, log, fx.raw_rates(spark), reference, fx.SOURCE, now(),
                          str(tmp_path / "layers"), prefix="t_")
    assert layers["dm_fact_transaction"].count() == 105
    results = layers["infra_check_results"].filter("status != 'pass'").collect()
    # A zero booking has no label, and no label passes; all else holds.
    assert results == []
    assert layers["infra_data_quality_freshness"].first().freshness_status == "fresh"
    one = layers["dm_account_balance"].filter("period_grain = 'Month' AND target_currency = 'RUB'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_grain" in plan
    # With masks that miss categories the build stops before the masked marts.
    reference.accounts_demo = fx.accounts(spark)
    reference.masks = spark.createDataFrame(
        [("Income", "Salary", "A", "B", Decimal(2))],
        "real_parent_category string, real_category string, demo_parent_category string, "
        "demo_category string, amount_factor decimal(18,6)")
    with pytest.raises(ValueError, match="categories_are_mapped: 4"):
        build_layers(landed, log, fx.raw_rates(spark), reference, fx.SOURCE, now(),
                     str(tmp_path / "layers"), prefix="t_")


def test_check_history_and_current_results(spark, tmp_path):
    def results(*failures):
        return spark.createDataFrame(
            [("core_t", f"check_{n}", "warn", f, "warn" if f else "pass")
             for n, f in enumerate(failures)],
            "model_name string, test_name string, severity string, failures long, status string")

    path = str(tmp_path / "checks")
    for target, run, failures in (("dev", "r1", [0, 1]), ("prod", "r1", [5]), ("dev", "r1", [9, 9]),
                                  ("dev", "r2", [3])):
        log_checks(results(*failures), path, target, run, now())
    history = spark.read.parquet(f"{path}/history")
    assert sorted((r.target_name, r.invocation_id, r.failures) for r in history.collect()) == [
        ("dev", "r1", 0), ("dev", "r1", 1), ("dev", "r2", 3), ("prod", "r1", 5)]
    current = spark.read.parquet(f"{path}/current")
    assert sorted((r.target_name, r.invocation_id, r.failures) for r in current.collect()) == [
        ("dev", "r2", 3), ("prod", "r1", 5)]


def test_a_failed_write_leaves_the_table_whole(spark, tmp_path):
    path, frame = str(tmp_path / "layer"), spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "n long, p string, q string")
    first = sinks.materialize(frame, "kept_layer", "table", path, ["p"])
    assert first.columns == ["n", "p", "q"] and sorted(map(tuple, first.collect())) == [(1, "a", "x"), (2, "b", "y")]
    broken = frame.withColumn("q", F.when(F.col("n") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("q")))
    with pytest.raises(Exception, match="no"):
        sinks.materialize(broken, "kept_layer", "table", path, ["p"])
    assert spark.table("kept_layer").count() == 2
    again = sinks.materialize(frame.filter("n = 1"), "kept_layer", "table", path, ["p"])
    # A reader that began before the change still finds its files.
    assert first.count() == 2 and again.count() == spark.table("kept_layer").count() == 1
    plan = again.filter("p = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    spark.sql("DROP VIEW kept_layer")


def test_wrong_reference_data_stops_the_build(spark, tmp_path):
    names = spark.createDataFrame(fx.accounts(spark).collect()[:3], DIM_ACCOUNTS)
    reference = Reference(names, fx.tags(spark, ("regular", True), ("rent", True)),
                          fx.tags(spark, ("from reserve", True)))
    with pytest.raises(ValueError, match="accounts_exist_in_dim_accounts: 1.*at_most_one_active_row"):
        build_layers(fx.raw(spark), fx.registry(spark), fx.raw_rates(spark), reference, fx.SOURCE,
                     now(), str(tmp_path / "layers"), prefix="u_")

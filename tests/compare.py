"""Run registered queries against DuckDB on the same parquet files and compare the rows.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    return value


def rows(table) -> Counter:
    """Multiset of the rows of an Arrow table, columns in order of name."""
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return Counter(zip(*columns)) if table.num_rows else Counter()


def _kind(arrow_type) -> str:
    text = str(arrow_type).replace("large_string", "string").replace("string_view", "string")
    return text.split("[")[0] if text.startswith("timestamp") else text


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    got = build(spark, sf_dir).toArrow()
    took = time.time() - start
    if sql is None:
        return True, f"{name}: {got.num_rows} rows, {took:.1f} s, no SQL"
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return False, f"{name}: columns {got.column_names} != {want.column_names}"
    types = {
        n: (_kind(got.schema.field(n).type), _kind(want.schema.field(n).type))
        for n in got.column_names
    }
    wrong = {n: t for n, t in types.items() if t[0] != t[1]}
    a, b = rows(got), rows(want)
    if a != b:
        return False, (f"{name}: {got.num_rows} rows != {want.num_rows}; only Spark "
                       f"{list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}; {wrong}")
    return not wrong, f"{name}: {got.num_rows} rows, {took:.1f} s" + (f", types {wrong}" if wrong else "")


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session("8"), duck(sf_dir)
    named, sqls = queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or named:
        try:
            same, line = compare(spark, con, name, named[name], sqls.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            same, line = False, f"{name}: {type(error).__name__} {str(error)[:600]}"
        bad += not same
        print("ok  " if same else "BAD ", line, flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))

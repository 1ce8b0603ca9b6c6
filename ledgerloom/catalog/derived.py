"""A ledger derived from the given tables, in SQL that Spark and DuckDB both accept.

The given tables hold no ledger, so orders become transactions, suppliers accounts, parts
exchange rates and events the history of loads. The texts below only build *inputs*: raw,
untidy text as it would land. A third of all transactions belongs to one account.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.core import core_rates, core_transactions
from ledgerloom.plans.staging import stg_rates, stg_transactions
from ledgerloom.session import shared_dir, spread, tune

SYSTEM, OBJECT, TABLE = SOURCE = ("ledger_app", "ledger", "raw_ledger")
AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31 00:00:00"

DIM_ACCOUNTS = """
SELECT CAST(s_suppkey AS INT) AS account_id,
       s_name AS account_name,
       DATE '1994-01-01' + CAST(s_suppkey % 365 AS INT) AS opening_date,
       CAST(s_acctbal AS DECIMAL(18,2)) AS initial_amount,
       CASE s_suppkey % 3 WHEN 0 THEN 'RUB' WHEN 1 THEN 'USD' ELSE 'KGS' END AS currency,
       s_suppkey % 10 <> 9 AS is_active,
       s_suppkey % 5 = 1 AS is_reserve,
       s_suppkey % 4 = 2 AS is_credit
FROM {supplier}
"""

# Every eleventh account has no masked twin.
DIM_ACCOUNTS_DEMO = """
SELECT account_id, 'Demo ' || CAST(account_id AS STRING) AS account_name, opening_date,
       initial_amount, currency, is_active, is_reserve, is_credit
FROM ({dim_accounts_sql}) AS a
WHERE account_id % 11 <> 10
"""

# Own and counter account number of each order.
_KEYED_ORDERS = """
SELECT o.*, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % n END AS k,
       (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % n END + 1) % n AS counter,
       CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM (SELECT o.*, (SELECT count(*) FROM {supplier}) AS n FROM {orders} AS o) AS o
"""

_RAW_BATCH = """
SELECT o_orderkey * 4 + {batch} AS raw_id,
       CAST(o_orderkey AS STRING) AS source_number,
       ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' '
           || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':30:00' AS transaction_date,
       CASE WHEN o_orderkey % 101 = 0
            THEN 'Ghost ' || CAST(o_orderkey % 7 AS STRING)
            ELSE '  ' || s.s_name || ' ' END AS account,
       CASE WHEN o_orderkey % 97 = 0 THEN '0'
            ELSE CASE WHEN o_orderstatus = 'O' THEN '' ELSE '- ' END
                 || replace(CAST(price AS STRING), '.', ',') END AS amount,
       CASE WHEN o_orderkey % 211 = 0 THEN 'eur'
            ELSE CASE k % 3 WHEN 0 THEN ' rub' WHEN 1 THEN 'usd ' ELSE 'Kgs' END
            END AS currency,
       o_orderpriority AS parent_category,
       CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'S' || CAST(o_orderkey % 4 AS STRING) END
           AS subcategory,
       'C' || CAST(o_orderkey % 7 AS STRING) AS category,
       CASE WHEN o_orderkey % 9 = 0 THEN '   ' ELSE 'P' || CAST(o_custkey AS STRING) END
           AS counterparty,
       CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 11 = 0 THEN NULL
            ELSE t.s_name END AS transfer_account,
       CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 13 = 0 THEN ''
            ELSE replace(CAST(price * 2 AS STRING), '.', ',') END AS transfer_amount,
       CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 17 = 0 THEN NULL
            ELSE CASE counter % 3 WHEN 0 THEN 'rub' WHEN 1 THEN 'usd' ELSE 'kgs' END
            END AS transfer_currency,
       CASE o_orderkey % 6 WHEN 0 THEN 'recurring' WHEN 1 THEN 'travel, reserve'
            WHEN 2 THEN 'recurring, reserve' WHEN 3 THEN 'recurring,reserve' WHEN 4 THEN ''
            END AS tags,
       'Place ' || CAST(o_orderkey % 5 AS STRING) AS place,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL
            ELSE 'order ' || CAST(o_orderkey AS STRING) END AS note,
       TIMESTAMP '2001-08-01 00:00:00' AS ingested_at,
       'loader' AS ingested_by,
       'exports/{batch}.csv' AS source_file,
       CAST({batch} AS BIGINT) AS ingestion_id
FROM (""" + _KEYED_ORDERS + """) AS o
JOIN {supplier} AS s ON s.s_suppkey = k
JOIN {supplier} AS t ON t.s_suppkey = counter
"""


def _raw_batches() -> str:
    """Batch 1 is older, batch 2 is the newest loaded one, batch 3 failed half way."""
    halves = {1: "WHERE o_orderkey % 2 = 1", 2: "", 3: "WHERE o_orderkey % 2 = 0"}
    return "\nUNION ALL\n".join(
        _RAW_BATCH.replace("{batch}", str(n)) + where for n, where in halves.items()
    )


RAW_TRANSACTIONS = _raw_batches()

LEDGER_REGISTRY = """
SELECT ingestion_id, 'ledger_app' AS source_system, 'ledger' AS source_object,
       'raw_ledger' AS raw_table, source_file AS s3_key,
       CASE WHEN ingestion_id = 3 THEN 'failed' ELSE 'loaded' END AS status,
       CAST(count(*) AS INT) AS rows_loaded
FROM ({raw_transactions_sql}) AS r
GROUP BY ingestion_id, source_file
"""

# Every third day of 82 years; parts beyond those are rates of further currencies.
RAW_RATES = """
SELECT p_partkey AS raw_id,
       CASE WHEN p_partkey % 97 = 5 THEN ' ecb' ELSE 'cbr ' END AS source,
       CASE p_partkey % 2 WHEN 0 THEN 'R01235' ELSE 'R01370' END AS source_rate_key,
       substr(CAST(d AS STRING), 9, 2) || '.' || substr(CAST(d AS STRING), 6, 2) || '.'
           || substr(CAST(d AS STRING), 1, 4) AS rate_date,
       CASE WHEN turn > 0 THEN 'c' || CAST(2 * turn + p_partkey % 2 AS STRING)
            WHEN p_partkey % 2 = 0 THEN 'usd' ELSE ' Kgs ' END AS base_currency,
       CASE WHEN p_partkey % 89 = 7 THEN '0'
            WHEN p_partkey % 2 = 0 THEN '1' ELSE '10' END AS base_amount,
       'rub' AS quote_currency,
       replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING), '.', ',') AS quote_amount,
       TIMESTAMP '2001-08-01 00:00:00' AS ingested_at,
       'loader' AS ingested_by
FROM (SELECT p.*, CAST(floor(p_partkey / 20002) AS BIGINT) AS turn,
             DATE '1995-03-01' + CAST(3 * floor(p_partkey % 20002 / 2) AS INT) AS d
      FROM {part} AS p) AS p
"""

RECURRING_TAG = """
SELECT 'recurring' AS tag, TRUE AS is_active UNION ALL SELECT 'rent', FALSE
"""
RESERVE_TAG = """
SELECT 'reserve' AS tag, TRUE AS is_active UNION ALL SELECT 'travel', FALSE
"""
# More than one active tag: rows with several of them multiply.
MANY_TAGS = """
SELECT 'recurring' AS tag, TRUE AS is_active UNION ALL SELECT 'reserve', TRUE
UNION ALL SELECT 'travel', TRUE UNION ALL SELECT 'unseen', TRUE UNION ALL SELECT 'rent', FALSE
"""

# One pair is left out on purpose, one is there twice, and some names and factors are missing.
CATEGORY_MASK = """
SELECT DISTINCT o_orderpriority AS real_parent_category,
       'C' || CAST(o_orderkey % 7 AS STRING) AS real_category,
       'Group ' || substr(o_orderpriority, 1, 1) AS demo_parent_category,
       'Item ' || CAST(o_orderkey % 7 AS STRING) AS demo_category,
       CAST(CAST(40 + 7 * CAST(substr(o_orderpriority, 1, 1) AS INT) + 5 * (o_orderkey % 7)
                 AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) AS amount_factor
FROM {orders}
WHERE NOT (substr(o_orderpriority, 1, 1) = '5' AND o_orderkey % 7 = 6)
"""
DIRTY_MASK = """
SELECT real_parent_category, real_category, demo_parent_category,
       CASE WHEN real_category = 'C3' THEN '  ' ELSE demo_category END AS demo_category,
       CASE WHEN real_category = 'C4' THEN NULL ELSE amount_factor END AS amount_factor
FROM ({category_mask_sql}) AS m
UNION ALL
SELECT real_parent_category, real_category, demo_parent_category, demo_category, amount_factor
FROM ({category_mask_sql}) AS m WHERE real_category = 'C1'
"""

LOAD_REGISTRY = """
SELECT event_id AS ingestion_id,
       'events' AS source_system,
       'u' || CAST(user_id AS STRING) AS source_object,
       'raw_events' AS raw_table,
       'bucket' AS s3_bucket,
       'u' || CAST(user_id AS STRING) || '/' || CAST(event_id AS STRING) || '.csv' AS s3_key,
       CAST(event_id * 10 AS BIGINT) AS file_size_bytes,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'loaded' END AS status,
       CAST(floor(CAST(value AS DECIMAL(18,2)) * 10) AS INT) AS rows_loaded,
       CAST(NULL AS STRING) AS error_message,
       CAST(ts AS TIMESTAMP) AS discovered_at,
       CAST(ts AS TIMESTAMP) AS started_at,
       CASE WHEN event_id % 1009 = 1008 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS finished_at
FROM {events}
"""

_TEXTS = {
    "dim_accounts": DIM_ACCOUNTS,
    "dim_accounts_demo": DIM_ACCOUNTS_DEMO,
    "raw_transactions": RAW_TRANSACTIONS,
    "ledger_registry": LEDGER_REGISTRY,
    "raw_rates": RAW_RATES,
    "recurring_tag": RECURRING_TAG,
    "reserve_tag": RESERVE_TAG,
    "many_tags": MANY_TAGS,
    "category_mask": CATEGORY_MASK,
    "dirty_mask": DIRTY_MASK,
    "load_registry": LOAD_REGISTRY,
}


@cache
def text(name: str) -> str:
    """SQL of a derived table down to the given tables, which stay as ``{table}``."""
    sql = _TEXTS[name]
    for other in _TEXTS:
        marker = "{" + other + "_sql}"
        if marker in sql:
            sql = sql.replace(marker, text(other))
    return sql


GIVEN = ["orders", "supplier", "part", "events"]


def duckdb_sql(name: str) -> str:
    """A derived table as SQL over the given tables by their own names."""
    sql = text(name)
    for table in GIVEN:
        sql = sql.replace("{" + table + "}", table)
    return sql


class Tables:
    """The given tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self._frames: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _TEXTS:
            raise AttributeError(name)
        if name not in self._frames:
            sql = text(name)
            frames = {t: self.given(t) for t in GIVEN if "{" + t + "}" in sql}
            if "orders" in frames:
                frames["orders"] = spread(frames["orders"])
            self._frames[name] = self.spark.sql(sql, **frames)
        return self._frames[name]

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("date")

    def staged(self) -> DataFrame:
        return stg_transactions(self.raw_transactions, self.ledger_registry, *SOURCE)

    def staged_rates(self) -> DataFrame:
        return stg_rates(self.raw_rates)

    def ledger(self) -> DataFrame:
        """The canonical ledger, computed where it is used."""
        return core_transactions(self.staged(), self.dim_accounts, self.as_of)

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """A relation written to the shared folder and read back: what several later steps
        read is computed once, and lost executors do not lose it."""
        path = shared_dir(self.spark, label)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def stored_ledger(self) -> DataFrame:
        return self.stored(self.ledger(), "ledger")

    def stored_rates(self) -> DataFrame:
        return self.stored(core_rates(self.staged_rates()), "rates")

"""Registered streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.derived import SOURCE, Tables
from ledgerloom.catalog.landing import (
    _CLEAN, _LANDED, _NEW_AMOUNT, _TEXT, _catalog, as_of, export_folder, rate_documents,
)
from ledgerloom.catalog.registry import query
from ledgerloom.schemas import FILE_REGISTRY, RAW_RATE_TEXT
from ledgerloom.session import shared_dir
from ledgerloom.sources.rates import read_rate_table
from ledgerloom.sources.sinks import read_version
from ledgerloom.streaming.ingest import stream_ingest, stream_upsert_rates


@query("stream_ingest", f"SELECT {_LANDED}, TRUE AS is_registered FROM raw_transactions")
def stream_exports(t: Tables):
    inbox, raw, entries, state = (
        shared_dir(t.spark, name) for name in ("inbox", "raw", "registry", "state")
    )
    inbox = export_folder(t)
    # The second start finds nothing new.
    for _ in range(2):
        stream_ingest(t.spark, inbox, raw, entries, state, SOURCE, as_of()).awaitTermination()
    loaded = read_version(t.spark, entries, FILE_REGISTRY)[0].filter("status = 'loaded'")
    rows = t.spark.read.parquet(raw)
    known = loaded.select("ingestion_id", F.lit(True).alias("is_registered"))
    return rows.join(known, "ingestion_id", "left").select(*_TEXT, "is_registered")


# Three overlapping waves: even rates; most rates, some corrected; a third of them, corrected once more.
_THIRD = "CASE WHEN raw_id % 7 < 3 THEN '7' || quote_amount ELSE quote_amount END"


@query("stream_upsert_rates", f"""
    SELECT 'cbr' AS source, arg_max(source_rate_key, wave) AS source_rate_key, rate_date,
           base_currency, arg_max(base_amount, wave) AS base_amount, 'RUB' AS quote_currency,
           arg_max(quote_amount, wave) AS quote_amount
    FROM (SELECT *, 1 AS wave FROM ({_CLEAN}) WHERE raw_id % 2 = 0
          UNION ALL SELECT * REPLACE ({_NEW_AMOUNT} AS quote_amount), 2 FROM ({_CLEAN})
          WHERE raw_id % 3 <> 2 OR raw_id % 2 = 1
          UNION ALL SELECT * REPLACE ({_THIRD} AS quote_amount), 3 FROM ({_CLEAN}) WHERE raw_id % 3 = 0)
    GROUP BY rate_date, base_currency
""")
def stream_rates(t: Tables):
    inbox, table, state = (shared_dir(t.spark, name) for name in ("rates", "table", "state"))
    catalog = t.stored(_catalog(t), "codes")
    waves = (
        t.raw_rates.filter("raw_id % 2 = 0"),
        t.raw_rates.filter("raw_id % 3 <> 2 OR raw_id % 2 = 1").withColumn("quote_amount", F.expr(_NEW_AMOUNT)),
        t.raw_rates.filter("raw_id % 3 = 0").withColumn("quote_amount", F.expr(_THIRD)),
    )
    # Each start goes on from the checkpoint of the one before.
    for rows in waves:
        rate_documents(rows, inbox)
        stream_upsert_rates(t.spark, inbox, table, state, catalog, as_of()).awaitTermination()
    return read_rate_table(t.spark, table)[0].select(*RAW_RATE_TEXT)

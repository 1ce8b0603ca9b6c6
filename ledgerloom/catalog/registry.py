"""Where queries register, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.derived import Tables
from ledgerloom.catalog.oracle import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _wall_time(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the other engine reads them."""
    stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def query(name: str, sql: str | None):
    """Register a function of the tables under a name."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: _wall_time(build(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build

    return register

"""What several of these operators share: tables, stored intermediates, sized broadcasts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir

#: A side is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 16 << 20

#: Words of near-duplicate and decontamination work: runs of letters and digits, lower-cased.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: a lineage cut that outlives
    the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, f'llm-{label}')}/rows"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows one; else left to a shuffle join,
    where adaptive execution splits hot keys."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def text_key(text: Column | str) -> Column:
    """16 bytes that stand for a text; null for null. Rows are matched by it, since doc_id may
    repeat or be null."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def word_array(text: Column | str) -> Column:
    """Lower-cased words of a text; empty for null."""
    parts = F.split(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))),
                    WORD_BREAK)
    return F.array_remove(parts, "")


def any_of(columns: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, columns)

"""Small inputs with everything that may go wrong in them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"

# Extra columns carry names that the operators use inside.
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, node string, words string, key string"
PAGE_SCHEMA = "page_id long, url string, html string, host string, payload string, text string"


def documents(spark: SparkSession, texts: list, ids: list | None = None, langs: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    langs = [None] * len(texts) if langs is None else langs
    rows = [(i, t, lang, None, len(t or ""), "n", None, "k") for i, t, lang in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def pages(spark: SparkSession, rows: list) -> DataFrame:
    """rows: (page_id, url, html)."""
    return spark.createDataFrame([(*r, "h", None, "t") for r in rows], PAGE_SCHEMA)


def prose(n: int, seed: int = 0, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]
    lines = [" ".join(words[i:i + 9]) + "." for i in range(0, n, 9)]
    return "\n".join(lines)


def odd_texts() -> list:
    return [None, "", " ", "\n\n", "a", "a b c d", "...", "é ñ", "\x00", "x" * 50_000, "ab " * 20_000,
            "a b c d e", "a b c d e", prose(60, 1), prose(60, 1)]

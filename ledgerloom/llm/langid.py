"""Language identification by compression.

For each language a raw-content dictionary for zstandard is made of labelled texts. A text, in lower
case and with one space for whatever lies between words, is compressed with every dictionary; the
language whose dictionary gives the fewest bytes is chosen. Where the two smallest sizes are close
the choice is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bounds of the training sample: bytes of a language's dictionary, about how many labelled texts
#: of a language, those with the smallest hashes, are looked at to fill it, characters taken of each
#: (of a longer text a stretch at a place that its hash chooses), and languages, those with most rows.
DICTIONARY_BYTES = 100_000
SAMPLE_TEXTS = 400
STRETCH = 20_000
MOST_LANGUAGES = 1_000
LEVEL = 5
MIN_MARGIN = 0.02

_BETWEEN = re.compile(r"[\W\d_]+")


def normalised(text: str) -> bytes:
    return _BETWEEN.sub(" ", text.lower()).encode()


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries by language, from rows that are not held out and have lang, text and doc_id; the
    language with most rows first."""
    rows = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                       & F.col("text").rlike(r"\p{L}"))
    place = F.xxhash64("text", "doc_id")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {r["lang"]: r["count"] for r in common.collect()}
    # A share of each language that holds about SAMPLE_TEXTS texts; the hash decides, not the order.
    keep = F.lit(False)
    for lang, n in counts.items():
        share = min(1.0, SAMPLE_TEXTS / n)
        keep = keep | ((F.col("lang") == lang) & (F.pmod(place, F.lit(1 << 40)) < int(share * (1 << 40))))
    spare = F.greatest(F.length("text") - STRETCH + 1, F.lit(1))
    part = F.substring("text", (F.pmod(place, spare) + 1).cast("int"), F.lit(STRETCH))
    sample = rows.filter(keep).select("lang", part.alias("text"), place.alias("place")).collect()
    dictionaries = {}
    for lang in sorted(counts, key=lambda lang: (-counts[lang], lang)):
        parts, size = [], 0
        for row in sorted((r for r in sample if r["lang"] == lang), key=lambda r: (r["place"], r["text"])):
            raw = normalised(row["text"])
            if size + len(raw) <= DICTIONARY_BYTES:
                parts.append(raw)
                size += len(raw)
        if parts:
            dictionaries[lang] = b"\n".join(parts)
    return dictionaries


def _chooser(dictionaries: dict[str, bytes]):
    """Function of a text: (language, score, rejected)."""
    import zstandard as zstd

    order = list(dictionaries)
    tools = []
    for lang in order:
        own = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=LEVEL)
        tools.append(zstd.ZstdCompressor(dict_data=own, level=LEVEL, write_checksum=False,
                                         write_content_size=False, write_dict_id=False))

    def choose(text: str | None) -> tuple[str, float, bool]:
        if not text or not order or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        raw = normalised(text)
        sizes = [len(t.compress(raw)) for t in tools]
        best = min(range(len(order)), key=sizes.__getitem__)
        if len(order) == 1:
            return order[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = 1 - sizes[best] / second
        return order[best], margin, margin < MIN_MARGIN
    return choose


def identified(docs: DataFrame, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row of ``docs``.

    ``score`` is how much smaller the best size is than the second best, 0 to 1; below ``MIN_MARGIN``
    the choice is rejected, though it is still named. Texts that are null or without letters are
    ``und`` with score 0; so is every text if nothing could be learned. Ties go to the language
    with more labelled texts. A null doc_id is neither held out nor learned from.
    """
    learned = fitted(docs) if dictionaries is None else dictionaries

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        choose = _chooser(learned)
        for texts in batches:
            yield pd.DataFrame([choose(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("found"))
            .select("doc_id", "held_out", "found.*"))

"""Line-first cleaning: rules for lines, then a verdict on what is left of the document.

Every line with a word is held against rules on navigation, symbols, shouting, repetition,
punctuation and boilerplate. Lines that fail go; a document that loses too large a share of its
words goes as a whole. Document-wide counts of the whole, uncleaned text come along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_SHARE = 0.5

# Characters that count as symbols, phrases of web boilerplate.
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "click here", "sign up for our newsletter",
    "subscribe to our newsletter", "lorem ipsum", "skip to content",
)

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SENTENCE_MARK = re.compile(r"[.!?,;:…。！？،؟।]")
_SEPARATOR = re.compile(r"[|»›•·]")


def failed_rule(line: str, words: list[str]) -> str | None:
    """The first rule that a line with words fails, or None."""
    count, chars = len(words), sum(map(len, words))
    separators = len(_SEPARATOR.findall(line))
    if separators >= 2 and 5 * separators >= count:
        return "navigation"
    if count >= 3 and 10 * sum(map(line.count, SYMBOLS)) > chars:
        return "symbols"
    if count >= 5 and line.upper() == line and line.lower() != line:
        return "shouting"
    if count >= 10 and 5 * len(set(words)) <= count:
        return "repetition"
    if count >= 8 and not _SENTENCE_MARK.search(line):
        return "punctuation"
    low = line.lower()
    if any(phrase in low for phrase in BOILERPLATE):
        return "boilerplate"
    return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    inside = bytearray(len(words))
    for i, window in enumerate(windows):
        if times[window] > 1:
            inside[i:i + 3] = b"\1\1\1"
    return sum(inside)


def judge(text: str | None) -> dict:
    """Counts of the whole text, the cleaned text and the verdict."""
    text = text or ""
    words = _WORDS.findall(text)
    seen: set[str] = set()
    duplicates = kept_words = failed = 0
    kept = []
    for line in text.split("\n"):
        own = _WORDS.findall(line)
        if not own:
            continue
        if line in seen:
            duplicates += 1
            failed += 1
            continue
        seen.add(line)
        if failed_rule(line, own):
            failed += 1
            continue
        kept.append(line)
        kept_words += len(own)
    repeats = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": duplicates,
        "n_repeat_words": repeats, "base_failed": base_failed,
        "kept": not base_failed and kept_words >= MIN_KEPT_SHARE * len(words),
        "n_failed_lines": failed, "kept_words": kept_words, "clean_text": "\n".join(kept),
    }


COUNTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_failed_lines long, kept_words long")


def _judged(with_text: bool):
    schema = COUNTS + (", clean_text string" if with_text else "")
    names = [c.split()[0] for c in schema.split(", ")]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [judge(t) for t in texts]
            yield pd.DataFrame({n: [f[n] for f in found] for n in names})
    return run.asNondeterministic()  # else a filter on the verdict would judge each text twice


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, counts and verdict for every row of ``docs``.

    Null and empty texts have no words, so they fail. A line equal to an earlier one of its text is
    removed. Rows may repeat; an empty table gives no rows; other columns are not read.
    """
    return docs.select("doc_id", _judged(False)("text").alias("rules")).select("doc_id", "rules.*")


def cleaned(docs: DataFrame) -> DataFrame:
    """Kept rows of ``docs`` with all their columns; ``text`` without its failed lines, and
    ``n_chars``, if there is one, brought in line."""
    kept = (docs.withColumn("__rules", _judged(True)("text")).filter("__rules.kept")
            .withColumn("text", F.col("__rules.clean_text")).drop("__rules"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)

"""Cleaning and typing of landed text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerloom.schemas import ERROR_TEXT_LIMIT, RATE_DATE_FORMATS, TIMESTAMP_FORMAT


def clean_text(text: Column) -> Column:
    """Strip spaces (only spaces) at both ends; an empty rest is NULL."""
    return F.nullif(F.btrim(text), F.lit(""))


def normalize_code(text: Column) -> Column:
    """A cleaned code in upper case."""
    return F.upper(clean_text(text))


def _checked(parsed: Column, text: Column, what: str, strict: bool) -> Column:
    """In strict mode text that does not parse fails the job whatever the ANSI setting."""
    if not strict:
        return parsed
    message = F.concat(F.lit(f"not a {what}: "), text)
    return F.coalesce(parsed, F.when(text.isNotNull(), F.raise_error(message)))


def parse_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT, strict: bool = True) -> Column:
    """Cleaned text to a timestamp."""
    return _checked(F.try_to_timestamp(text, F.lit(fmt)), text, "timestamp", strict)


def parse_date_by_source(
    text: Column, source: Column, formats: dict[str, str] = RATE_DATE_FORMATS, strict: bool = True
) -> Column:
    """Cleaned text to a date in the format of its source; an unknown source gives NULL."""
    parsed = F.lit(None).cast("date")
    for name, fmt in formats.items():
        value = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        parsed = F.when(source == name, _checked(value, text, "date", strict)).otherwise(parsed)
    return parsed


def parse_decimal(text: Column, to: DecimalType, strict: bool = True) -> Column:
    """Cleaned text with spaces and a decimal comma to a number, rounded half up."""
    plain = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return _checked(plain.try_cast(to), text, "number", strict)


def truncate_text(text: Column, limit: int = ERROR_TEXT_LIMIT) -> Column:
    """The first ``limit`` characters."""
    return F.left(text, F.lit(limit))


def is_blank(text: Column) -> Column:
    """NULL, empty, or spaces only."""
    return text.isNull() | (F.btrim(text) == "")


def any_missing(texts: list[Column], others: list[Column] = ()) -> Column:
    """Whether any text is blank or any other value is NULL."""
    return reduce(or_, [*map(is_blank, texts), *(value.isNull() for value in others)])

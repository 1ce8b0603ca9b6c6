"""Content hash of a ledger row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import HASH_SEPARATOR

# Fixed order of the hashed columns: ids depend on it.
HASHED_COLUMNS = [
    "source_number", "transaction_ts", "account", "amount", "currency", "parent_category",
    "subcategory", "category", "counterparty", "transfer_account", "transfer_amount",
    "transfer_currency", "tags", "place", "note", "transfer_type", "source_file",
]
_UNTRIMMED = {"source_number", "transaction_ts", "amount", "transfer_amount"}


def _part(name: str) -> Column:
    text = F.col(name).cast("string")
    if name not in _UNTRIMMED:
        text = F.btrim(text)
    if name == "currency":
        text = F.upper(text)
    return F.coalesce(text, F.lit(""))


def content_hash(columns: list[str] = HASHED_COLUMNS) -> Column:
    """MD5 over all parts; a missing part is an empty one, so positions never shift."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *map(_part, columns)).cast("binary"))

"""Registered queries over the given tables, each with the SQL that must agree with it."""

from ledgerloom.catalog import (  # noqa: F401
    checks, columns, landing, marts, relations, streams,
)
from ledgerloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

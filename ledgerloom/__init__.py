"""Ledger analytics on Spark: raw text exports to typed ledgers, marts and monitoring."""

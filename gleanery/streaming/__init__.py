"""Structured Streaming forms of the ledger and queue operators."""

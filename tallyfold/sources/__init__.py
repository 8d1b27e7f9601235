"""Readers of raw files and tables, the file manifest, and idempotent writers."""

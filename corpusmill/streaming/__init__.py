"""Incremental variants of row filters and exact deduplication over Structured Streaming."""

"""Structured Streaming forms of ingest, capture dedup and the match tally."""

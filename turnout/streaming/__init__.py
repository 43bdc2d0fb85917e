"""Structured Streaming ingest (ST1-ST9)."""

"""Structured Streaming: incremental ingest of daily files and running daily totals."""

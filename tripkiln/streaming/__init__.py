"""Incremental ingest with Structured Streaming (file source, foreachBatch)."""

from tripkiln.streaming.ingest import gold_stream, silver_stream  # noqa: F401

"""Incremental ingestion with Structured Streaming (available-now file streams)."""

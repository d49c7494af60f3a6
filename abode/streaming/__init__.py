"""Incremental ingest of raw batch files with Structured Streaming."""

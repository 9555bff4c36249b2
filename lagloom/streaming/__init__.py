"""Structured Streaming forms of ingest and resampling."""

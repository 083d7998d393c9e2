"""Incremental pipelines on Structured Streaming."""

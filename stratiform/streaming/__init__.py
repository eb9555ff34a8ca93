"""Incremental layers with Structured Streaming."""

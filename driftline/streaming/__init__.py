"""Incremental collection on Structured Streaming."""

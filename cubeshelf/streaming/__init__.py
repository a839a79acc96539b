"""Incremental runs driven by Structured Streaming."""

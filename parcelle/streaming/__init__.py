"""Incremental processing of newly landed files with Structured Streaming."""

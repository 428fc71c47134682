"""Incremental gate over newly landed fact files (Structured Streaming)."""

"""Readers and writers: monthly fact files, hourly payloads, CSV lookup, catalog tables."""

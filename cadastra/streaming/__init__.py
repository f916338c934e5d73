"""Incremental ingest of newly published files."""

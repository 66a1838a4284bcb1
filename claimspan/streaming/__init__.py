"""Incremental ingest of claims and streaming frequency alerts."""

"""Structured Streaming versions of the incremental steps (ingest, scoring, id dedup)."""

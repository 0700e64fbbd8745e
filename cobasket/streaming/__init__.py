"""Structured Streaming jobs: file ingest with dedup, running pair counts."""

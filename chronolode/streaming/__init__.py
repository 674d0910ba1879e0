"""Structured Streaming jobs: ingest and subscription."""

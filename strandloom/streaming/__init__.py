"""Structured Streaming ingest of new samples."""

"""Incremental ingest as micro-batches."""

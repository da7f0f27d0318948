"""Batch tables, CSV ingest and message streams."""

"""Incremental ingestion as file streams."""

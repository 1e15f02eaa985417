"""Streaming ingestion of snapshot files."""

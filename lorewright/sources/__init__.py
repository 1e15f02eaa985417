"""Readers and writers of snapshot files."""

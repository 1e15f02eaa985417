"""Relational operators over snapshot tables."""

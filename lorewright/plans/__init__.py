"""Registered queries and the step pipeline."""

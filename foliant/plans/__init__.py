"""Whole pipelines and their queries."""

"""Operators for large training-data pipelines (search, dedup, filters, mixing)."""

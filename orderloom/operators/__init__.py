"""Reusable DataFrame operators: dedup, counting, lookup joins, data checks."""

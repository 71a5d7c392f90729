"""Reusable DataFrame operators: joins, text aggregation, checks, refresh, text index."""

"""Rental analytics on Spark: replicated tables, staging, star schema, reports, checks."""

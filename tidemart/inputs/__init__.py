"""Warehouse inputs derived from the given tables, in Spark and as SQL text."""

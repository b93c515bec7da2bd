"""Readers: topics, change records, relational tables, dimensions, text files."""

"""Writers: topics, keyed upserts, dimensions, databases, day-partitioned files."""

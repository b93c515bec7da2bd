"""A realtime retail warehouse expressed as PySpark DataFrame jobs."""

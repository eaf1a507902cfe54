"""Point-in-time time-series analytics as PySpark DataFrame and Structured Streaming jobs."""

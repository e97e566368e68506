"""Incremental batch ingestion and reporting as plain Spark DataFrame jobs."""

"""Statute analytics expressed as Spark DataFrame and SQL jobs."""

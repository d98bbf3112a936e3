"""Spark-first data quality, migration and code-readiness engine."""

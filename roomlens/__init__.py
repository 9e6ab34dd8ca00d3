"""Retail clickstream and catalogue analytics as plain Spark DataFrame jobs."""

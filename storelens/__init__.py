"""Retail analytics as Spark DataFrame jobs."""

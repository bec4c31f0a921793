"""Murmur: mention and sentiment analytics as Spark DataFrame jobs."""

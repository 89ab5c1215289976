"""Planetary catalogue analytics as Spark DataFrame jobs."""

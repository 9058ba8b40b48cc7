"""Furlong: race-result analytics as Spark DataFrame and SQL jobs."""

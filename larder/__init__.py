"""Larder: grocery and food-waste analytics as plain Spark DataFrame jobs."""

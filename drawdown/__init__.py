"""Consumption metrics over contracts and usage logs, as Spark DataFrame jobs."""

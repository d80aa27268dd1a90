"""Rollout scoring and evaluation analytics as plain Spark DataFrame jobs."""

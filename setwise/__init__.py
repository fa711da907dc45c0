"""Spark operators and jobs for wearable-sensor workout sessions."""

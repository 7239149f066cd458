"""Curling telemetry analytics on Spark: tracking, quality metrics, features and graphs."""

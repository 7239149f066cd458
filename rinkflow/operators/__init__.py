"""Relational operators of the telemetry pipeline."""

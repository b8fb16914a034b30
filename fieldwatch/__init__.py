"""Spark analytics for well and tank telemetry."""

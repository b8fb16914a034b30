"""Schemas and sources of telemetry."""

"""Operators of the telemetry engine."""

"""Structured Streaming jobs: telemetry stream, live exertion table, alert log, health."""

"""Structured Streaming wiring: pipelines, sinks, replay, health."""

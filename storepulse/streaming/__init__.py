"""Structured Streaming jobs, their sinks and triggers."""

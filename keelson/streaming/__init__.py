"""Structured Streaming jobs and the windowed aggregates they share with batch."""

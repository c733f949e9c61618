"""Structured Streaming jobs over the same transformations."""

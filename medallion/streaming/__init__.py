"""Structured Streaming jobs around the same plans."""

"""Structured Streaming jobs over quote messages."""

"""Structured Streaming jobs over customer events."""

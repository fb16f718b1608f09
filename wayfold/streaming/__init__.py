"""Structured Streaming forms of the matcher."""

"""Extraction as Structured Streaming queries."""

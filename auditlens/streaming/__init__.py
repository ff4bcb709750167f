"""Structured Streaming monitors (family M)."""

"""Structured Streaming path."""

"""Structured Streaming operators and their outputs."""

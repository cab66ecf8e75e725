"""Structured Streaming wiring for the same DataFrame operators."""

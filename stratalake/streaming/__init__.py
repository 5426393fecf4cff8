"""Structured Streaming forms of the load and report operators."""

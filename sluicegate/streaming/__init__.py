"""Structured Streaming forms of the batching operator and its sink."""

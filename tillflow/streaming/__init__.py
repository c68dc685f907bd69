"""Incrementally maintained views, in batch and in Structured Streaming."""

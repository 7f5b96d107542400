"""Structured Streaming forms of the stateless and dedup operators."""

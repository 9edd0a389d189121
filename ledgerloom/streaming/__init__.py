"""Structured Streaming forms of collection and aggregation."""

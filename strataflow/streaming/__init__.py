"""Structured Streaming forms of the raw -> clean -> report jobs."""

"""Structured Streaming delivery of the incremental load."""

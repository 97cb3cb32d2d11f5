"""Structured Streaming versions of the two incremental loads."""

"""Structured Streaming versions of the online recall products."""

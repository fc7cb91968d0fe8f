"""Streams over the request log."""

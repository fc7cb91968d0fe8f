"""Readers."""

from shardloom.sources.tables import table  # noqa: F401

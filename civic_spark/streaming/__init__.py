"""Structured Streaming entry points: incremental landing of raw feed files."""

from . import ingest  # noqa: F401

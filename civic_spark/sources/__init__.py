"""Scans and sinks for the raw yearly feeds and derived datasets."""

from . import readers, schemas, sinks  # noqa: F401

"""Incremental ingest of landed slots and windowed flow on a stream."""

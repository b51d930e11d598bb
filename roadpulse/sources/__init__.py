"""Readers and writers: landed CSV, archives, listings, dimensions, the lake."""

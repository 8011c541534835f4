"""Continuous ingest of landed snapshot files."""

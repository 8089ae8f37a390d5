"""Incremental updates, for batch and streaming frames."""

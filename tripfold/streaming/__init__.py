"""Incremental form of the preparation step."""

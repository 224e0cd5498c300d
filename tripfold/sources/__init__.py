"""Readers, writers and the place for intermediate tables."""

"""Readers of the dump files."""

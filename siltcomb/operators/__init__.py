"""Relational steps of an extraction."""

"""Dumps and events as streams."""

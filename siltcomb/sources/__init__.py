"""Readers of monthly dumps and side tables."""

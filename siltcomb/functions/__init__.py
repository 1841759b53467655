"""Expressions and small driver-side functions."""

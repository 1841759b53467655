"""Operators for building training data out of large text tables.

The subpackage stands alone: nothing else in the library imports it.
"""

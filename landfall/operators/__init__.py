"""Lookups, dimensions, the fact and its quality checks, as DataFrame functions."""

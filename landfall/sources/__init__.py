"""Readers, label files, and the shared test tables in source shape."""

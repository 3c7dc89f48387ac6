"""Arrivals analytics on Spark: lookups, four dimensions, one fact, quality checks."""

"""Operators for large training-data corpora, on Spark."""

"""Recommendation analytics on Spark: rating tables, rating streams, served lists."""

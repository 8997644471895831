"""Layered data platforms on Spark: reshape, key, check and promote tables."""

"""Operators of a training-data pipeline: cleaning, deduplication, formatting and packing of texts."""

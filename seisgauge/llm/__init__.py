"""Operators of a training-data pipeline: filters, deduplication, output and packing of texts."""

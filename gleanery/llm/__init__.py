"""Operators for training-data pipelines: deduplication, quality, search, encoding, packing, sharding."""

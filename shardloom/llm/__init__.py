"""Operators for training-data pipelines: identification, dedup, search, encoding, packing, scoring."""

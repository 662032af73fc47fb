"""Operators for training-data pipelines: filters, dedup, sanitising, tokens and packing."""

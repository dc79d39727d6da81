"""Operators for training-data corpora: filters, dedup, search, archives, mixing, packing."""

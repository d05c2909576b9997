"""Operators for large-scale training data: deduplication, filtering, scoring and encoding of text corpora."""

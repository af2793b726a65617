"""Operators for building training data: extraction, near-duplicate removal,
scoring, mixing, packing and formatting of large document tables."""

"""Operators for large text corpora: filters, deduplication, search, scoring, counting, mixing, packing."""

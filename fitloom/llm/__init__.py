"""Operators for preparing text corpora: deduplication, filtering, archives and tokens."""

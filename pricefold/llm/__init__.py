"""Operators for building training corpora at scale (language, search, sharding, filters, dedup)."""

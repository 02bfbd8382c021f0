"""Operators for preparing training data: scoring, deduplication, tokens, packing, search."""

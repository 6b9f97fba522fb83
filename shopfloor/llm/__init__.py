"""Operators for preparing training data: search, filtering, extraction, tokens, packing, duplicates."""

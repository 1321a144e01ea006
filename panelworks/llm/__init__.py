"""Operators that prepare training data: filtering, deduplication, tokens, packing, search, archives."""

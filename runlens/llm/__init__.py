"""Operators for preparing training text: extraction, filtering, near-copies, sharding, mixing, tokens, search."""

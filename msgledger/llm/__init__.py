"""Operators for preparing training text: cleaning, deduplication, search, mixing, tokens."""

"""Operators for preparing training text: deduplication, mixing, tokens, formatting, scoring, sharding."""

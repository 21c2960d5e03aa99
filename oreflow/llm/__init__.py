"""Operators for preparing training text: tokenization, deduplication, quality, mixing, archives and scoring."""

"""Operators for preparing training text: extraction, filters, near-duplicates, tokens, packing."""

"""Operators for preparing training text: detection, filters, deduplication, tokens, archives and vector search."""

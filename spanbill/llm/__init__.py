"""Operators for preparing training text: sharding, filtering, deduplication, scanning, tokenizing."""

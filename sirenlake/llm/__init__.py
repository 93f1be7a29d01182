"""Operators for preparing training text: filtering, deduplication, search, mixing and tokenising."""

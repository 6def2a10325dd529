"""Operators for preparing training text: quality, tokens, mixing, decontamination, archives, duplicates, sharding, lists, pages."""

"""Operators for preparing training text: licences, cleaning, tokens, packing, deduplication, chat, search."""

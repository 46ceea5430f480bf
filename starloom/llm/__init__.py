"""Operators for preparing training text: scoring, near duplicates, search, licences, mixing, extraction."""

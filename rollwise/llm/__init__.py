"""Operators of a training-data pipeline: dedup, mixing, encoding, language, search, filters, extraction, secrets, rules."""

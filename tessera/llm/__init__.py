"""Operators of a training-data pipeline: dedup, language, search, packing, privacy."""

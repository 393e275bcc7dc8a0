"""Operators of a training-data pipeline: extraction, duplicates, quality, language, leaks, packing."""

"""Operators of a training-data pipeline: archives, language, quality, duplicates, packing."""

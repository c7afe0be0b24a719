"""Operators of a training-data pipeline: quality, privacy, language models, duplicates, packing.

Nothing else in the library imports this package.
"""

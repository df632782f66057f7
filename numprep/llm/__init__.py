"""Operators of a training-data pipeline: filters, extraction, counts, shards, deduplication, mixing and token files.

Nothing else in the library imports this package.
"""

"""Preparing a large text corpus for training: filters, deduplication, scoring, mixing and packing.

Nothing else in the library imports this package.
"""

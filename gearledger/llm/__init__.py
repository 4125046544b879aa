"""Operators of a training-data pipeline: deduplication, packing, filtering, scoring, search and mixing."""

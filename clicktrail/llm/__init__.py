"""Operators of a training-data pipeline: archives, duplicates, private data, packing, mixing, search and filters."""

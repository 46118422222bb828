"""Operators of a training-data pipeline: tokens, packing, filters, near duplicates, search."""

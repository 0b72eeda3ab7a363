"""Operators of a training-data pipeline: de-duplication, cleaning, scoring and packing of text."""

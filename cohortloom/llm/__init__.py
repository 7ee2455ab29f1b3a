"""Operators of a training-data pipeline: dedup, filters, scoring, mixing, token files."""

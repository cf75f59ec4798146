"""Operators for training-data pipelines: tokens, near duplicates, quality, personal data, mixing, search."""

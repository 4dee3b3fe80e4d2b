"""Operators for training data: text statistics, deduplication, mixing, token files, scoring and search."""

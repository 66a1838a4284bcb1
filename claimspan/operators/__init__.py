"""Distributed building blocks: ordered sums, trailing counts, quality checks."""

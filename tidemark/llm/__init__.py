"""Operators on text corpora. Nothing outside this package imports it."""

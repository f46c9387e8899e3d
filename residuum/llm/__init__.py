"""Operators for large text corpora. Nothing outside this folder imports it."""

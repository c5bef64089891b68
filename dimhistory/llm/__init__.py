"""Operators for preparing text corpora, one module each."""

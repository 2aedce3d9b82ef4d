"""Operators for text corpora that train language models."""

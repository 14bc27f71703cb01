"""Operators for corpora of training data."""

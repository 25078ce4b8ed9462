"""Operators for preparing training data: scoring, mixing, tokens, filters, near and exact duplicates."""

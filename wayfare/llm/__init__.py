"""Operators for training-data corpora: tokens, rules, near duplicates, personal data, main text, id files."""

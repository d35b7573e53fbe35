"""Operators for training data: sampling, repair, runs, near-duplicates, languages, tokens, leaks, quality."""

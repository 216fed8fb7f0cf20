"""Operators for corpora of training text, apart from the clinical library."""

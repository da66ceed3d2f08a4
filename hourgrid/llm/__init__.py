"""Operators for training corpora: filters, extraction, duplicates, mixing.

Nothing else in the library imports this subpackage.
"""

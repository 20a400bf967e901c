"""Operators for training-data preparation (documents, pages, benchmark items).

Nothing else in the library imports this package.
"""

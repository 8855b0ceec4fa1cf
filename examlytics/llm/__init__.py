"""Operators for large text corpora (personal data, quality, tokens, duplicates, secrets).

Every operator is a function from DataFrames to a DataFrame. Nothing outside
this package imports it; ``queries.py`` holds the registered queries.
"""

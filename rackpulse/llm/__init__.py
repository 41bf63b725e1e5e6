"""Operators for preparing language-model training data at scale.

Nothing else in the library imports this subpackage. Each operator takes and
returns DataFrames; ``queries.py`` registers the thin queries over the given
tables.
"""
